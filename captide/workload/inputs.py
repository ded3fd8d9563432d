"""Shows, documents and commercial records made from the rows of the test tables."""

from __future__ import annotations

import io
import tarfile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.sources.files import locate

SEGMENT_SECONDS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def escaped(text: Column) -> Column:
    """Text for use between XML or HTML tags."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def element(tag: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.concat(F.lit(f"<{tag}>"), escaped(value), F.lit(f"</{tag}>"))


def show_id(source: str = "source", lang: str = "lang", doc_id: str = "doc_id") -> Column:
    return F.concat_ws("_", F.upper(source), lang, F.col(doc_id).cast("string"))


def shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One show per document: its lines are the caption segments."""
    return table(spark, sf_dir, "documents").withColumn("identifier", show_id())


def labelled_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shows with a label; the others have no commercial record."""
    return shows(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")


def container(line: Column, index: Column, link: Column | None = None, snippet: Column | None = None) -> Column:
    """A caption container; ``link`` and ``snippet`` replace the sound parts."""
    start = index * SEGMENT_SECONDS
    sound_link = F.concat(
        F.lit('<a href="/start/'), start, F.lit("/end/"), start + SEGMENT_SECONDS, F.lit('"></a>')
    )
    sound_snippet = F.concat(F.lit('<div class="snipin nosel">'), escaped(line), F.lit("</div>"))
    return F.concat(
        F.lit('<div class="tvcol">'),
        sound_link if link is None else F.coalesce(link, sound_link),
        sound_snippet if snippet is None else F.coalesce(snippet, sound_snippet),
        F.lit("</div>"),
    )


def page(text: Column, link: Column | None = None, snippet: Column | None = None) -> Column:
    """The caption page of a text, one container per line."""
    containers = F.transform(F.split(text, "\n"), lambda line, index: container(line, index, link, snippet))
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>captions</title><script>var t='<div>';</script></head><body>"),
        F.array_join(containers, "\n"),
        F.lit("</body></html>"),
    ).cast("binary")


def caption_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(archive_id, content)`` of all shows."""
    return shows(spark, sf_dir).select(F.col("identifier").alias("archive_id"), page(F.col("text")).alias("content"))


def faulty_caption_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``caption_pages``, with a fault that depends on the language."""
    link = F.when(F.col("lang") == "de", "").when(F.col("lang") == "es", "<a name='x'></a>")
    snippet = F.when(F.col("lang") == "fr", "<div>no captions</div>")
    content = page(F.col("text"), link, snippet)
    return shows(spark, sf_dir).select(F.col("identifier").alias("archive_id"), content.alias("content"))


def commercial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(archive_id, intervals, pos)``: one record per labelled show, a later second one for toxic shows."""
    labelled = labelled_shows(spark, sf_dir)
    start = F.col("n_chars") % 40 * 1000.0
    bounds = F.array(
        F.array(start, start + 25000.0),
        F.array(F.lit(83000.0), F.lit(87000.0)),
        F.array(F.lit(155000.5), F.lit(171000.0)),
    )
    everything = F.array(F.array(F.lit(0.0), F.lit(1e9)))
    first = labelled.select(F.col("identifier").alias("archive_id"), bounds.alias("intervals"), F.lit(0).alias("pos"))
    second = labelled.filter("toxic = 1").select(
        F.col("identifier").alias("archive_id"), everything.alias("intervals"), F.lit(1).alias("pos")
    )
    return first.unionByName(second)


def labelled_or_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shows(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")


def meta_body() -> Column:
    """The metadata of a show up to its last element, from the columns of ``labelled_or_not``."""
    nothing = F.lit("")
    return F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<metadata>\n'),
        element("identifier", F.col("identifier")),
        element("mediatype", "movies"),
        element("contributor", F.upper("source")),
        element("language", F.col("lang")),
        element("collection", F.concat(F.lit("TV-"), F.upper("source"))),
        element("collection", "tvarchive"),
        F.lit("<runtime/>"),
        element("title", F.get(F.split("text", "\n"), F.lit(0))),
        F.coalesce(element("quality", F.col("quality").cast("string")), nothing),
        F.when(F.col("toxic") == 1, element("subject", "toxic")).otherwise(nothing),
        element("subject", F.col("lang")),
        element("collection", "tvnews"),
        element("description", F.col("text")),
    )


def meta_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(identifier, content)``: the metadata XML of all shows."""
    content = F.concat(meta_body(), F.lit("\n</metadata>\n")).cast("binary")
    return labelled_or_not(spark, sf_dir).select("identifier", "lang", content.alias("content"))


def faulty_meta_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata with a wrong closing tag for German shows and an early end for Spanish ones."""
    ending = F.when(F.col("lang") == "de", "\n</metadat>\n").when(F.col("lang") == "es", "\n<tit").otherwise("</metadata>")
    content = F.concat(meta_body(), ending).cast("binary")
    return labelled_or_not(spark, sf_dir).select("identifier", content.alias("content"))


def listed_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identifier list; toxic shows are listed twice."""
    once = shows(spark, sf_dir).select("identifier")
    return once.unionByName(labelled_shows(spark, sf_dir).filter("toxic = 1").select("identifier"))


def write_archives(members: DataFrame, folder: str, mode: str, suffix: str) -> None:
    """Write ``(name, content)`` rows as tar archives, one per task; a repeated task replaces its own."""

    def store(batches):
        system, base = locate(folder)
        system.create_dir(base, recursive=True)
        part = f"part-{TaskContext.get().partitionId():06d}{suffix}"
        with system.open_output_stream(f"{base}/{part}", compression=None) as sink:
            with tarfile.open(fileobj=sink, mode=mode) as archive:
                for batch in batches:
                    for row in batch.to_pylist():
                        entry = tarfile.TarInfo(row["name"])
                        entry.size = len(row["content"])
                        archive.addfile(entry, io.BytesIO(row["content"]))
        yield pa.RecordBatch.from_pylist([{"done": 1}], schema=pa.schema([("done", pa.int64())]))

    members.select("name", "content").mapInArrow(store, "done BIGINT").write.format("noop").mode("overwrite").save()
