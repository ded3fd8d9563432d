"""Reading caption pages out of tar archives."""

from __future__ import annotations

import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.editions import Edition
from captide.functions.identifiers import member_archive_id
from captide.operators.commercials import shows_with_records
from captide.sources import tar_index
from captide.sources.files import locate

_BATCH_BYTES = 16 * 1024 * 1024
_TASK_BYTES = 64 * 1024 * 1024
_MEMBERS = pa.schema([("name", pa.string()), ("content", pa.binary())])


def list_archives(spark: SparkSession, folder: str, pattern: str = "*.tar*") -> DataFrame:
    """``(path, length)`` of the archives in a folder; their content is not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
    )


def _in_batches(rows, schema: pa.Schema, size):
    """Arrow batches of rows, closed when ``size`` of their rows passes the bound."""
    batch, held = [], 0
    for row in rows:
        batch.append(row)
        held += size(row)
        if held >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(batch, schema=schema)
            batch, held = [], 0
    if batch:
        yield pa.RecordBatch.from_pylist(batch, schema=schema)


def _stream_members(batches):
    """All regular files of each archive, in one pass over its bytes."""

    def members():
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = locate(path)
                with system.open_input_stream(name, compression=None) as source:
                    with tarfile.open(fileobj=source, mode="r|*") as archive:
                        for member in archive:
                            if member.isfile():
                                yield {"name": member.name, "content": archive.extractfile(member).read()}

    yield from _in_batches(members(), _MEMBERS, lambda row: len(row["content"]))


def _read_ranges(batches):
    """The bytes of indexed members; neighbours in one archive share the open file."""

    def members():
        for batch in batches:
            opened, source = None, None
            for row in batch.to_pylist():
                if row["path"] != opened:
                    if source is not None:
                        source.close()
                    system, name = locate(row["path"])
                    opened, source = row["path"], system.open_input_file(name)
                source.seek(row["start"])
                yield {"name": row["name"], "content": source.read(row["size"])}
            if source is not None:
                source.close()

    yield from _in_batches(members(), _MEMBERS, lambda row: len(row["content"]))


def _one_per_task(archives: DataFrame) -> DataFrame:
    return archives.select("path").repartitionByRange(max(1, archives.count()), "path")


def read_members(archives: DataFrame, edition: Edition, wanted: DataFrame | None = None) -> DataFrame:
    """``(archive_id, content)`` of the pages in compressed archives, one task per archive.

    Compression makes an archive one sequential stream, so parallelism comes from the
    number of archives. Write the result once as Parquet and work from there. Members
    that are gzip files themselves stay so; the page parsers inflate them.
    """
    members = _one_per_task(archives).mapInArrow(_stream_members, "name STRING, content BINARY")
    return _pages(members, edition, wanted)


def read_plain_members(archives: DataFrame, edition: Edition, wanted: DataFrame | None = None) -> DataFrame:
    """As ``read_members`` for uncompressed archives, which many tasks can share.

    The member list is built by many tasks per archive (``tar_index``: speculative
    headers per range, chained over range ends). It is reduced to the wanted shows and
    spread by position, so one archive that holds most of the pages is read by many
    tasks and unwanted bytes are not read.
    """
    index = tar_index.index_archives(archives)
    index = index.withColumn("archive_id", member_archive_id(F.col("name"), edition))
    index = index.filter(F.col("archive_id").isNotNull())
    if wanted is not None:
        index = shows_with_records(index, wanted)
    # The rows are short but stand for many bytes, so the number of tasks is given.
    stored = archives.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, -(-stored // _TASK_BYTES))
    spread = index.repartitionByRange(tasks, "path", "start").sortWithinPartitions("path", "start")
    members = spread.select("path", "name", "start", "size").mapInArrow(_read_ranges, "name STRING, content BINARY")
    return _pages(members, edition, None)


def _pages(members: DataFrame, edition: Edition, wanted: DataFrame | None) -> DataFrame:
    pages = members.select(member_archive_id(F.col("name"), edition).alias("archive_id"), "content")
    pages = pages.filter(F.col("archive_id").isNotNull())
    return pages if wanted is None else shows_with_records(pages, wanted)
