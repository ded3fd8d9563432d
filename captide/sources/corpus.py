"""Corpus and text files in CSV form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header of a CSV file or folder."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def read_corpus(spark: SparkSession, path: str, columns: list[str] | None = None, mode: str = "FAILFAST") -> DataFrame:
    """A quoted CSV corpus, every column a string; gzip is known by the file name.

    Empty cells are NULL, quoted or not; tokens such as ``NA`` are text. Texts hold
    line breaks, so a file is not split: keep release files bounded. A row with more or
    fewer cells than columns ends the read; ``mode="DROPMALFORMED"`` leaves it out.
    """
    names = csv_columns(spark, path) if columns is None else columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", mode)
        .csv(path)
    )
