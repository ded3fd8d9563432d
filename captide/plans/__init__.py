"""Whole jobs, from raw files to release files."""
