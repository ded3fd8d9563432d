"""Work on the catalogue: search, lookups, outstanding work and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.functions.identifiers import normal_date
from captide.operators.ordering import first_in_order

# The collection that is searched, and the row limit of the original search for those who want it.
COLLECTION = "tvarchive"
SEARCH_LIMIT = 1_500_000


def search_catalogue(
    shows: DataFrame, start_date: str | None = None, limit: int | None = None, collection: str = COLLECTION
) -> DataFrame:
    """Identifiers of a collection, from a date on: all, or the first ``limit`` in identifier order.

    The date is checked loosely and may lack leading zeros. ``shows`` has ``identifier``, ``collection ARRAY<STRING>`` and ``date STRING``.
    """
    found = shows.filter(F.array_contains("collection", collection))
    if start_date:
        found = found.filter(F.col("date") >= normal_date(start_date))
    found = found.select("identifier")
    return found if limit is None else first_in_order(found, "identifier", limit)


def lookup(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose column is one of a few known values; reaches the scan as a filter."""
    return df.filter(F.col(column).isin(values))


def pending_work(identifiers: DataFrame, stored: dict[str, DataFrame]) -> DataFrame:
    """``(identifier, kind)``: what has still to be fetched, judged for each kind alone."""
    wanted = identifiers.select("identifier")
    missing = [
        wanted.join(have.select("identifier"), "identifier", "left_anti").withColumn("kind", F.lit(kind))
        for kind, have in stored.items()
    ]
    work = missing[0]
    for part in missing[1:]:
        work = work.unionByName(part)
    return work


def ingest_report(identifiers: DataFrame, stored: dict[str, DataFrame], tagged: DataFrame) -> DataFrame:
    """``(measure, n)``: listed shows, stored documents of each kind, and different tags."""
    counts = [identifiers.agg(F.count("*").alias("n")).select(F.lit("listed").alias("measure"), "n")]
    for kind, have in stored.items():
        counts.append(have.agg(F.count("*").alias("n")).select(F.lit(f"stored_{kind}").alias("measure"), "n"))
    tags = tagged.select(F.explode(F.map_keys("tags")).alias("tag")).agg(F.count_distinct("tag").alias("n"))
    counts.append(tags.select(F.lit("tags").alias("measure"), "n"))
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report
