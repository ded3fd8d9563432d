"""From parsed documents to the wide show table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.functions.captions import parse_snippets
from captide.functions.tags import parse_tags, tag_value
from captide.operators.skew import balanced_join
from captide.session import broadcast_if_small, spread


def tag_documents(documents: DataFrame, compat: bool = False) -> DataFrame:
    """``(identifier, tags, error, truncated)`` of metadata documents."""
    documents = spread(documents.select("identifier", "content"))
    parsed = documents.select("identifier", "content", parse_tags(F.col("content"), compat).alias("parsed"))
    return parsed.select("identifier", "parsed.tags", error_or_missing("parsed.error"), "parsed.truncated")


def error_or_missing(error: str) -> Column:
    """The error of a parsed document; one without content is faulty too."""
    return F.when(F.col("content").isNull(), "no content").otherwise(F.col(error)).alias("error")


def good_tags(parsed: DataFrame) -> DataFrame:
    """``(identifier, tags)`` of the documents that could be parsed."""
    return parsed.filter(F.col("error").isNull()).select("identifier", "tags")


def tag_quarantine(parsed: DataFrame) -> DataFrame:
    """``(identifier, stage, error)`` of the documents that could not be parsed."""
    return parsed.filter(F.col("error").isNotNull()).select("identifier", F.lit("meta").alias("stage"), "error")


def caption_texts(pages: DataFrame) -> DataFrame:
    """``(identifier, text, error)``: all snippets of a page without a separator.

    Pages without captions have an empty text.
    """
    pages = spread(pages.select("identifier", "content"))
    parsed = pages.select("identifier", "content", parse_snippets(F.col("content")).alias("page"))
    return parsed.select("identifier", F.array_join("page.snippets", "").alias("text"), error_or_missing("page.error"))


def tag_inventory(tagged: DataFrame) -> DataFrame:
    """Every tag name that occurs (``tag``)."""
    return tagged.select(F.explode(F.map_keys("tags")).alias("tag")).distinct()


def tag_names(tagged: DataFrame) -> list[str]:
    """The sorted tag names, for use as columns: the only data that reaches the driver."""
    return sorted(row["tag"] for row in tag_inventory(tagged).collect())


def widen(tagged: DataFrame, names: list[str], *others: Column | str) -> DataFrame:
    """One string column per tag, NULL where a document lacks it, then ``others``."""
    return tagged.select(*[tag_value(F.col("tags"), name).alias(name) for name in names], *others)


def assemble_shows(identifiers: DataFrame, tagged: DataFrame, texts: DataFrame) -> DataFrame:
    """``(identifier, tags, text)`` for each listed show that has both documents.

    A show listed twice appears twice. ``tagged`` and ``texts`` hold one row per show.
    """
    documents = tagged.join(texts.select("identifier", "text"), "identifier")
    return balanced_join(identifiers.select("identifier"), documents, "identifier", right_is_unique=True)


def listed_documents(identifiers: DataFrame, *documents: DataFrame) -> list[DataFrame]:
    """Documents of each kind that belong to listed shows, so that only these are parsed.

    Applied when the list is small enough to broadcast. With a larger list nothing
    is dropped here, as raw documents would have to be shuffled; ``only_listed`` removes
    the rest after parsing.
    """
    wanted, small = broadcast_if_small(identifiers.select("identifier").distinct())
    return [kind.join(wanted, "identifier", "left_semi") if small else kind for kind in documents]


def only_listed(identifiers: DataFrame, parsed: DataFrame) -> DataFrame:
    """Parsed documents of listed shows: tags and texts are small enough to be joined with any list."""
    return parsed.join(identifiers.select("identifier").distinct(), "identifier", "left_semi")
