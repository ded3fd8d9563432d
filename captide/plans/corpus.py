"""The stages of a corpus, each reading and writing shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.editions import Edition
from captide.operators import commercials, release, shows
from captide.sinks.corpus import show_columns
from captide.sources.documents import read_documents


def compact_documents(spark: SparkSession, folder: str, kind: str, out: str, prefix: str = "") -> DataFrame:
    """Gather one file per show into Parquet once; everything later reads that.

    Rounds with different prefixes of the file names add to the same table.
    """
    read_documents(spark, folder, kind, prefix).write.mode("append").parquet(out)
    return spark.read.schema("identifier STRING, content BINARY").parquet(out)


def parse_shows(identifiers: DataFrame, meta: DataFrame, pages: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """The wide show table and the quarantine of a list of shows.

    Each document is parsed once, into a table under ``work``. Column names come from
    the keys in that table, so finding them does not parse again. Documents of shows that are
    not listed give no column and no fault, whatever the size of the list.
    """
    spark = identifiers.sparkSession
    parsed_path, texts_path = f"{work}/tags", f"{work}/texts"
    meta, pages = shows.listed_documents(identifiers, meta, pages)
    shows.tag_documents(meta).write.parquet(parsed_path)
    shows.caption_texts(pages).write.parquet(texts_path)
    parsed, texts = (shows.only_listed(identifiers, spark.read.parquet(path)) for path in (parsed_path, texts_path))
    tagged = shows.good_tags(parsed)
    names = shows.tag_names(tagged)
    assembled = shows.assemble_shows(identifiers, tagged, texts.filter(F.col("error").isNull()))
    wide = shows.widen(assembled, names, "text")
    faulty_texts = texts.filter(F.col("error").isNotNull()).select("identifier", F.lit("page").alias("stage"), "error")
    return wide.select([F.col(f"`{name}`") for name in show_columns(wide.columns)]), shows.tag_quarantine(
        parsed
    ).unionByName(faulty_texts)


def cut_edition(pages: DataFrame, records: DataFrame, edition: Edition, out: str) -> DataFrame:
    """Cut an edition into the table ``(archive_id, kept, error)`` at ``out``; one parse.

    ``cleaned_texts`` and ``cut_quarantine`` read the two sides of it.
    """
    commercials.examine_pages(pages, records, edition).write.parquet(out)
    return pages.sparkSession.read.parquet(out)


def cleaned_texts(examined: DataFrame) -> DataFrame:
    """``(archive_id, text_nc)`` of an examined edition."""
    good = examined.filter(F.col("error").isNull())
    return good.select("archive_id", commercials.joined_text(F.col("kept")).alias("text_nc"))


def cut_quarantine(examined: DataFrame) -> DataFrame:
    """``(archive_id, stage, error)`` of an examined edition."""
    return examined.filter(F.col("error").isNotNull()).select("archive_id", F.lit("cut").alias("stage"), "error")


def release_edition(corpus: DataFrame, cleaned: DataFrame, edition: Edition) -> DataFrame:
    """The corpus with ``text_nc`` and the name of its edition."""
    merged = release.merge_cleaned(corpus, cleaned, edition.repr_pattern)
    return merged.withColumn("edition", F.lit(edition.name))
