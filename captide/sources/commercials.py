"""Commercial records: the intervals of each show that are advertising."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.sources import json_array
from captide.sources.files import block_order

# Bounds are doubles: read as integers, one fractional bound would void the record.
SCHEMA = "archive_id STRING, intervals ARRAY<ARRAY<DOUBLE>>"


def read_commercials(spark: SparkSession, path: str, lines: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """``(archive_id, intervals, pos)``; ``pos`` orders records as they stand in the files.

    ``lines`` reads one record per line, which Spark can split. Without it each
    file is one JSON array, read by byte ranges in many tasks (``json_array``). A record that is
    no JSON, such as a line of an indented array read as lines, ends the read;
    ``mode="DROPMALFORMED"`` leaves it out.
    """
    if not lines:
        return json_array.read_json_array(spark, path, SCHEMA, mode)
    records = spark.read.schema(SCHEMA).option("multiLine", not lines).option("mode", mode).json(path)
    return records.select(
        "archive_id",
        "intervals",
        F.struct(
            block_order(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
    )
