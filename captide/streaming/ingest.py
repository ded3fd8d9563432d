"""Incremental ingest: parse new documents once, the first arrival of a show stays."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.functions.identifiers import GZIP_SUFFIX
from captide.operators.shows import caption_texts, tag_documents
from captide.session import broadcast_if_small, staged
from captide.sources.documents import SUFFIXES

PARSERS = {"meta": tag_documents, "page": caption_texts}
RAW_SCHEMA = "identifier STRING, content BINARY"


def raw_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A stream of raw documents from a growing Parquet folder."""
    reader = spark.readStream.schema(RAW_SCHEMA).format("parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    documents = reader.load(folder)
    origin = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return documents.select("identifier", "content", origin.alias("origin"))


def file_stream(spark: SparkSession, folder: str, kind: str, max_files: int | None = None) -> DataFrame:
    """A stream of document files, plain or compressed, from a growing folder."""
    suffix = SUFFIXES[kind]
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", f"*{suffix}{{,{GZIP_SUFFIX}}}")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    compressed = F.col("path").endswith(GZIP_SUFFIX)
    name = F.element_at(F.split("path", "/"), -1)
    ending = F.when(compressed, F.lit(len(suffix + GZIP_SUFFIX))).otherwise(F.lit(len(suffix)))
    # Within a batch the plain form of a document comes before the compressed one.
    origin = F.struct(compressed.alias("compressed"), F.col("path").alias("file"))
    return reader.load(folder).select(
        F.substring(name, F.lit(1), F.length(name) - ending).alias("identifier"), "content", origin.alias("origin")
    )


def chosen_documents(batch: DataFrame, ingested: DataFrame | None) -> DataFrame:
    """``(identifier, origin)`` of the first document of each show that is not ingested yet.

    The ingested identifiers are reduced to those of the batch before the anti join, so
    that only matches move.
    """
    first = batch.groupBy("identifier").agg(F.min("origin").alias("origin"))
    if ingested is not None:
        arrived, _ = broadcast_if_small(batch.select("identifier"))
        known = ingested.select("identifier").join(arrived, "identifier", "left_semi")
        first = first.join(known, "identifier", "left_anti")
    return first


def new_documents(batch: DataFrame, ingested: DataFrame | None) -> DataFrame:
    """The first document of each show in the batch that is not ingested yet.

    Decided on identifiers and origins alone; the content is read afterwards, for the
    chosen rows. That holds for a batch in files: the rows that a stream hands over
    are no scan, so ``ingest`` stores them first.
    """
    chosen, _ = broadcast_if_small(chosen_documents(batch, ingested))
    return batch.join(chosen, ["identifier", "origin"], "left_semi").select("identifier", "content")


def ingest(stream: DataFrame, kind: str, target: str, checkpoint: str) -> None:
    """Parse what has arrived into the Parquet table ``target`` and stop.

    A batch that is repeated after a failure finds its shows in the table and adds
    nothing. Documents that cannot be parsed are kept with their error.
    """
    spark = stream.sparkSession
    parse = PARSERS[kind]

    def append(batch: DataFrame, _batch_id: int) -> None:
        documents = new_documents(staged(batch, "arrived"), _existing(spark, target))
        parse(documents).write.mode("append").parquet(target)

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _existing(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.schema("identifier STRING").parquet(target)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
