"""Corpus files, growing show tables and bounded releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from captide.operators.skew import HEAVY_ROWS, heavy_keys, salted
from captide.session import staged

CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_corpus(df: DataFrame, path: str, max_rows: int = 0, compression: str = "gzip") -> None:
    """Quoted UTF-8 CSV with a header in every file, committed as a whole."""
    (
        df.write.options(**CSV_OPTIONS)
        .option("compression", compression)
        .option("maxRecordsPerFile", max_rows)
        .csv(path)
    )


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns of a show table, from its files; none if there is no table yet."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path).columns
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise


def append_shows(df: DataFrame, path: str, existing: list[str] | None = None, schema_mode: str = "merge") -> list[str]:
    """Append rows to a Parquet show table and return its columns from now on.

    Values go by name, so a new or a missing tag never moves another column.
    ``merge`` adds new columns, ``fail`` refuses them. The columns that the table has are
    read from it; who knows them for certain may give them as ``existing``.
    """
    if schema_mode not in ("merge", "fail"):
        raise ValueError(f"schema_mode must be merge or fail, not {schema_mode!r}")
    if existing is None:
        existing = stored_columns(df.sparkSession, path)
    new = [name for name in df.columns if name not in existing]
    if existing and new and schema_mode == "fail":
        raise ValueError(f"columns not in the table: {', '.join(new)}")
    df.write.mode("append").parquet(path)
    return show_columns({*existing, *df.columns})


def show_columns(names) -> list[str]:
    """Column order of a show table: sorted tags, the text last."""
    return sorted(set(names) - {"text"}) + (["text"] if "text" in names else [])


def read_shows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A show table written by several appends; columns a file lacks are NULL.

    With ``columns`` the file footers need not be merged first.
    """
    if columns is None:
        merged = spark.read.option("mergeSchema", True).parquet(path)
        return merged.select([F.col(f"`{name}`") for name in show_columns(merged.columns)])
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.schema(schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a table hashed and sorted by ``key``.

    Joins of two such tables on the key, with the same number of buckets, need no shuffle:
    worth it for pages, segments and corpus rows, which are joined again and again. A key
    with very many rows is written by several tasks, into several files of its bucket.
    """
    dealt = salted(df, key, heavy_keys(df, key), HEAVY_ROWS, "__salt").repartition(buckets, key, "__salt").drop("__salt")
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite").saveAsTable(table)


def write_release(
    df: DataFrame, path: str, max_rows: int, file_format: str = "parquet", gather: bool = False
) -> None:
    """Write one folder per edition in files of at most ``max_rows`` rows.

    Rows are written where they are. ``gather`` first brings an edition together, for
    input whose tasks hold few rows each; the rebalance hint lets adaptive execution
    split a large edition again, so one edition never means one task.
    """
    if gather:
        df = df.hint("rebalance", "edition")
    writer = df.write.partitionBy("edition").option("maxRecordsPerFile", max_rows)
    if file_format == "csv":
        writer = writer.options(**CSV_OPTIONS).option("compression", "gzip")
    writer.format(file_format).save(path)


def release_manifest(release: DataFrame) -> DataFrame:
    """``(edition, file, rows, bytes)`` of a release read back from its folder, by file name."""
    files = release.select(
        "edition",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    )
    counted = files.groupBy("edition", "file").agg(F.count("*").alias("rows"), F.max("bytes").alias("bytes"))
    return counted.select("edition", "file", "rows", "bytes").orderBy("edition", "file")


def shard_by_bytes(
    df: DataFrame, max_bytes: int, key: str, edition: str = "edition", oversized: str = "fail"
) -> DataFrame:
    """Give every row a ``shard`` within its edition so that no shard holds more than ``max_bytes``.

    A row's size is the length of its JSON form (``row_bytes``). Rows are range-partitioned and sorted by
    edition and ``key``; each task sums its rows as they come, the totals of all tasks (one row per task and
    edition) are composed by a window into offsets, and every row learns where it starts in its edition: a
    distributed prefix sum, no gathering. Shards are runs of ``max_bytes - largest row`` bytes of starts, so a
    shard never passes ``max_bytes``. If that leaves nothing, each row of more than half of ``max_bytes`` has a
    shard of its own; the others are summed without it, and cut into runs between two such rows. Shards come in
    key order; their numbers rise and may leave gaps.

    Rows are never cut. One of more than ``max_bytes`` is an error, or with ``oversized="alone"`` the only row
    of a shard, which is then as large as that row.
    """
    from pyspark import TaskContext

    if oversized not in ("fail", "alone"):
        raise ValueError(f"oversized must be fail or alone, not {oversized!r}")
    columns = df.columns
    half = max_bytes // 2
    sized = df.withColumn("row_bytes", F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))).cast("long"))
    shared = F.max(F.when(F.col("row_bytes") <= half, F.col("row_bytes")))
    largest, largest_shared = sized.agg(F.coalesce(F.max("row_bytes"), F.lit(0)), F.coalesce(shared, F.lit(0))).first()
    if largest > max_bytes and oversized == "fail":
        raise ValueError(f"a row of {largest} bytes does not fit a shard of {max_bytes}")
    shares = largest if largest < max_bytes else half
    stride = max(1, max_bytes - (largest if largest < max_bytes else largest_shared))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sized.repartitionByRange(tasks, edition, key).sortWithinPartitions(edition, key)
    extra = [("task", T.IntegerType()), ("before", T.LongType()), ("alone", T.LongType())]
    schema = T.StructType([*ordered.schema.fields, *(T.StructField(*field) for field in extra)])

    def running(frames):
        # Of each edition in this task: the bytes of rows that share shards, and the number of the others.
        task, held = TaskContext.get().partitionId(), {}
        for frame in frames:
            groups = frame[edition].astype(object).where(frame[edition].notna(), None)
            before, alone = [], []
            for group, size in zip(groups, frame["row_bytes"]):
                total, large = held.get(group, (0, 0))
                before.append(total)
                alone.append(large)
                held[group] = (total, large + 1) if size > shares else (total + int(size), large)
            yield frame.assign(task=task, before=before, alone=alone)

    placed = staged(ordered.mapInPandas(running, schema), "release-offsets")
    is_large = F.col("row_bytes") > shares
    totals = placed.groupBy("task", edition).agg(
        F.sum(F.when(~is_large, F.col("row_bytes")).otherwise(0)).alias("total"), F.count_if(is_large).alias("large")
    )
    earlier = Window.partitionBy(edition).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("task").alias("o_task"),
        F.col(edition).alias("o_edition"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("o_bytes"),
        F.coalesce(F.sum("large").over(earlier), F.lit(0)).alias("o_large"),
    )
    # One row per task and edition: far smaller than the rows, joined null-safe on the edition.
    joined = placed.join(offsets, (placed["task"] == offsets["o_task"]) & placed[edition].eqNullSafe(offsets["o_edition"]), "left")
    run = F.floor((F.col("o_bytes") + F.col("before")) / F.lit(stride))
    # Each large row is a shard, and ends the one before it.
    shard = run + 2 * (F.col("o_large") + F.col("alone")) + is_large.cast("int")
    return joined.select(*[placed[c] for c in columns], placed["row_bytes"], shard.cast("long").alias("shard"))


def write_release_by_bytes(
    df: DataFrame, path: str, max_bytes: int, key: str, file_format: str = "parquet", oversized: str = "fail"
) -> None:
    """One folder per edition and shard, each shard at most ``max_bytes`` of rows (see ``shard_by_bytes``)."""
    sharded = shard_by_bytes(df, max_bytes, key, oversized=oversized).drop("row_bytes")
    writer = sharded.repartition("edition", "shard").write.partitionBy("edition", "shard")
    if file_format == "csv":
        writer = writer.options(**CSV_OPTIONS).option("compression", "gzip")
    writer.format(file_format).save(path)
