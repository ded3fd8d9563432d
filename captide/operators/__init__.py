"""Operators on whole DataFrames: joins, cuts, assembly, reports."""
