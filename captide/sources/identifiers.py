"""Identifier lists and archive listings, with positions in list order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captide.editions import Edition
from captide.sources.files import block_order

# At about 200 bytes for a file name and three numbers, less than 64 MB.
MAX_BROADCAST_BLOCKS = 300_000


def with_position(scan: DataFrame, column: str = "pos") -> DataFrame:
    """Add the zero-based position of each row in the order of files and lines.

    ``scan`` must come straight from a file source. Rows are counted per file block
    first; the running total over the blocks then gives each block its offset, so
    no row has to move. The table of blocks is broadcast while the number of input
    splits, known without a job, proves it small.
    """
    located = scan.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    blocks = located.groupBy("__file", "__block").agg(
        F.min("__row").alias("__first"), F.count("*").alias("__rows")
    )
    order = block_order(F.col("__file"), F.col("__block"))
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "__file", "__block", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    # A block is a whole file or fills a task.
    if len(scan.inputFiles()) + located.rdd.getNumPartitions() <= MAX_BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    position = (F.col("__offset") + F.col("__row") - F.col("__first")).alias(column)
    return located.join(offsets, ["__file", "__block"]).select(*scan.columns, position)


def read_identifiers(spark: SparkSession, path: str, column: str | None = "identifier") -> DataFrame:
    """``(identifier, pos)`` of a CSV list: a column by name, or the first one for ``None``."""
    lines = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    chosen = lines.columns[0] if column is None else column
    return with_position(lines.select(F.col(f"`{chosen}`").alias("identifier")))


def skip_identifiers(identifiers: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` identifiers in list order: a filter on the position."""
    return identifiers.filter(F.col("pos") >= n)


def read_archive_listing(spark: SparkSession, path: str, edition: Edition) -> DataFrame:
    """``archive_id`` of each line of an archive's table of contents.

    The last part of the path is the file name. Editions that list other files too
    keep only the pages; the page suffix is removed wherever it occurs.
    """
    lines = spark.read.text(path)
    name = F.trim(F.element_at(F.split("value", "/"), -1), F.lit(" \t\r\n\f\v"))
    names = lines.select(name.alias("name"))
    if edition.listing_html_only:
        names = names.filter(F.col("name").endswith(edition.member_suffix))
    return names.select(F.replace("name", F.lit(edition.member_suffix)).alias("archive_id"))
