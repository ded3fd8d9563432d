"""Session settings, shared scratch storage and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

# What a builder should set for this workload. Caption pages are large values,
# so Arrow batches are bounded by bytes as well as by rows.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
    "spark.sql.session.timeZone": "UTC",
    # A release has a folder for every shard; by default each folder is listed by a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "48",
}

BROADCAST_BYTES = 64 * 1024 * 1024
SPREAD_BYTES_PER_CORE = 64 * 1024 * 1024


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a running session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder on the storage the cluster names for checkpoints.

    A machine-local folder is only used by a local session that names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="captide-")
    return f"{base.rstrip('/')}/captide/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back, so later steps reuse it."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def payload_bytes(df: DataFrame) -> int:
    """The size of ``df`` as JSON text: one scan with a map-side partial sum."""
    row_bytes = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    return df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast if its measured size allows it.

    Meant for sides that are cheap to scan, such as identifier lists and interval
    records. Above the bound the caller gets the plain DataFrame and ``False``.
    """
    if payload_bytes(df) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a small input before it is parsed in Python.

    A few files, or files with a single row group, make fewer tasks than there are
    cores. The shuffle is only made while the sources of ``df`` together stay below a
    fixed amount per core and in few files; other inputs have tasks enough and are
    left in place.
    """
    if is_remote():
        # A remote session tells nothing about its cores.
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    sources = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    estimate = sum(int(str(sources.apply(n).stats().sizeInBytes())) for n in range(sources.size()))
    if estimate > cores * SPREAD_BYTES_PER_CORE or len(df.inputFiles()) >= 2 * cores:
        return df
    return df.repartition(2 * cores)
