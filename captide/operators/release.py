"""Joining the cleaned text to the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.functions.text import strip_repr_columns
from captide.operators.skew import balanced_join


def merge_cleaned(corpus: DataFrame, cleaned: DataFrame, repr_pattern: str | None = None) -> DataFrame:
    """Every corpus row with ``text_nc``; NULL where the show was not cut.

    ``repr_pattern`` first strips byte literals in the compatible form. Repeated
    shows in ``cleaned`` repeat the corpus row.
    """
    if repr_pattern is not None:
        corpus = strip_repr_columns(corpus, repr_pattern)
    texts = cleaned.select(F.col("archive_id").alias("identifier"), "text_nc")
    merged = balanced_join(corpus, texts, "identifier", "left")
    return merged.select(*corpus.columns, "text_nc")


def cleaned_rows(release: DataFrame, *columns: str) -> DataFrame:
    """Rows that have a cleaned text, with the named columns (all for none)."""
    rows = release.filter(F.col("text_nc").isNotNull())
    return rows.select(*columns) if columns else rows
