"""Cutting commercials: which shows have records, which segments stay, what text is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captide.editions import Edition
from captide.functions.captions import parse_containers, timed_segments
from captide.session import broadcast_if_small, spread


def first_records(commercials: DataFrame, key: str = "archive_id", pos: str = "pos") -> DataFrame:
    """The first record of each show in input order.

    An aggregate, so repeated records of one show shrink before the shuffle.
    """
    return commercials.groupBy(key).agg(F.min_by("intervals", pos).alias("intervals"))


def shows_with_records(shows: DataFrame, commercials: DataFrame, key: str = "archive_id") -> DataFrame:
    """Rows of ``shows`` that have a commercial record (left semi join)."""
    return _semi(shows, commercials.select(key), key)


def records_in_edition(commercials: DataFrame, listing: DataFrame, key: str = "archive_id") -> DataFrame:
    """Commercial records of shows that the edition lists (left semi join)."""
    return _semi(commercials, listing.select(key), key)


def _semi(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    keys, _ = broadcast_if_small(keys)
    return rows.join(keys, key, "left_semi")


def _is_broken(interval: Column) -> Column:
    """Not a pair with a lower bound: a fault for every segment that gets to it."""
    return interval.isNull() | (F.size(interval) != 2) | F.get(interval, F.lit(0)).isNull()


def _is_open(interval: Column) -> Column:
    """A pair without an upper bound: a fault for a segment that gets to that bound."""
    return F.get(interval, F.lit(1)).isNull()


def _meets_open(segment: Column, intervals: Column) -> Column:
    """Whether a segment gets to a missing upper bound before an interval that it touches."""
    low = lambda interval: F.get(interval, F.lit(0))
    asks = lambda interval: _is_open(interval) & ((segment["start_ms"] >= low(interval)) | (segment["end_ms"] >= low(interval)))
    first_open = F.array_position(F.transform(intervals, asks), True)
    first_touched = F.array_position(F.transform(intervals, lambda interval: touches(segment, interval)), True)
    return (first_open > 0) & ((first_touched == 0) | (first_open < first_touched))


def touches(segment: Column, interval: Column) -> Column:
    """Whether a segment starts or ends inside an interval, bounds included.

    A segment that contains the whole interval does not touch it.
    """
    low, high = F.get(interval, F.lit(0)), F.get(interval, F.lit(1))
    touching = segment["start_ms"].between(low, high) | segment["end_ms"].between(low, high)
    return F.coalesce(touching, F.lit(False))


def sound_intervals(records: DataFrame, intervals: str = "intervals") -> DataFrame:
    """Replace ``intervals`` by those before the first that is no pair, and ``is_broken``.

    Intervals are tried in order, so the ones behind a broken one are never reached.
    Done before the join, once per record and not once per segment.
    """
    record = F.col(intervals)
    first_broken = F.array_position(F.transform(record, _is_broken), True)
    sound = F.when(first_broken > 0, F.slice(record, F.lit(1), (first_broken - 1).cast("int"))).otherwise(record)
    return records.withColumns(
        {
            intervals: F.coalesce(sound, F.array().cast("array<array<double>>")),
            "is_broken": F.coalesce(first_broken > 0, F.lit(True)),
        }
    )


def cut_segments(shows: DataFrame, segments: str = "segments", intervals: str = "intervals") -> DataFrame:
    """Replace both arrays by ``kept`` (segments outside commercials) and add ``cut_error``.

    Both sit in the same row, so nothing is shuffled. A broken interval is an error
    as soon as a segment gets to it, that is, if one is left over after the sound
    intervals before it. A segment without text is an error only if it is kept.
    """
    kept = F.filter(
        segments,
        lambda segment: ~F.exists(intervals, lambda interval: touches(segment, interval)),
    )
    others = [F.col(f"`{name}`") for name in shows.columns if name not in (segments, intervals)]
    # A generator of one row: later uses of ``kept`` read its result and do not cut again.
    has_open = F.exists(intervals, _is_open)
    stuck = has_open & F.exists(segments, lambda segment: _meets_open(segment, F.col(intervals)))
    cut = shows.select(*others, F.inline(F.array(F.struct(kept.alias("kept"), F.coalesce(stuck, F.lit(False)).alias("is_stuck")))))
    problem = F.when(F.col("is_stuck") | F.col("is_broken") & (F.size("kept") > 0), "interval is not a pair").when(
        F.exists("kept", lambda left_over: left_over["text"].isNull()), "segment without snippet"
    )
    return cut.withColumn("cut_error", problem).drop("is_broken", "is_stuck")


def joined_text(segments: Column) -> Column:
    """Texts of segments in order, without a separator."""
    return F.array_join(F.transform(segments, lambda segment: segment["text"]), "")


def segment_pages(pages: DataFrame, edition: Edition, content: str = "content") -> DataFrame:
    """Replace ``content`` by ``segments`` and ``page_error``: one parse per page."""
    parsed = spread(pages).withColumn("__page", parse_containers(F.col(content)))
    missing = F.when(F.col(content).isNull(), "no content")
    return parsed.withColumns(
        {
            "segments": timed_segments(F.col("__page.containers"), edition),
            "page_error": F.coalesce(missing, F.col("__page.error")),
        }
    ).drop("__page", content)


def examine_pages(pages: DataFrame, commercials: DataFrame, edition: Edition) -> DataFrame:
    """Cut every page that has a record: ``(archive_id, kept, error)``, one row per page.

    If the records are small enough to broadcast, pages without one are dropped
    before parsing and nothing is shuffled. Otherwise pages are parsed first, so
    the join moves segments and not raw pages; if at least the identifiers can be
    broadcast, pages without a record are dropped before that. A page meets one
    record at most, so a show with many pages is left to adaptive skew handling.
    """
    records = sound_intervals(first_records(commercials.filter(F.col("archive_id").isNotNull())))
    records, small = broadcast_if_small(records)
    pages = pages.select("archive_id", "content")
    if small:
        shows = segment_pages(pages.join(records, "archive_id"), edition)
    else:
        wanted, small = broadcast_if_small(records.select("archive_id"))
        if small:
            pages = pages.join(wanted, "archive_id", "left_semi")
        shows = segment_pages(pages, edition).join(records, "archive_id")
    cut = cut_segments(shows)
    return cut.select("archive_id", "kept", F.coalesce("page_error", "cut_error").alias("error"))


def cut_commercials(pages: DataFrame, commercials: DataFrame, edition: Edition) -> DataFrame:
    """``(archive_id, text_nc)`` of the pages with a record; faulty pages are left out.

    ``text_nc`` is empty, not NULL, if every segment is commercial.
    """
    examined = examine_pages(pages, commercials, edition)
    return examined.filter(F.col("error").isNull()).select("archive_id", joined_text(F.col("kept")).alias("text_nc"))


def faulty_pages(pages: DataFrame, commercials: DataFrame, edition: Edition) -> DataFrame:
    """``(archive_id, stage, error)`` of the pages that could not be cut."""
    examined = examine_pages(pages, commercials, edition)
    return examined.filter(F.col("error").isNotNull()).select("archive_id", F.lit("cut").alias("stage"), "error")


def keep_segment_rows(segments: DataFrame, intervals: DataFrame, key: str = "archive_id") -> DataFrame:
    """The cut on exploded tables: segment rows that touch no interval row of their show.

    ``segments`` has ``(key, start_ms, end_ms, …)``, ``intervals`` ``(key, low, high)``.
    An anti join on the key with a range condition, so a show with many rows can be
    split over tasks by skew handling.
    """
    s, i = segments.alias("s"), intervals.alias("i")
    inside = F.col("s.start_ms").between(F.col("i.low"), F.col("i.high")) | F.col("s.end_ms").between(
        F.col("i.low"), F.col("i.high")
    )
    return s.join(i, (F.col(f"s.{key}") == F.col(f"i.{key}")) & inside, "left_anti")


def keep_segment_rows_by_sweep(segments: DataFrame, intervals: DataFrame, key: str = "archive_id") -> DataFrame:
    """The same cut as ``keep_segment_rows``, by a sweep instead of comparing segments with intervals.

    A point lies in an interval (bounds included) exactly when the largest ``high`` among the intervals
    with ``low`` at or before it reaches it. Intervals and segments are taken together per show, sorted by
    position (intervals first at equal positions), and a running maximum of ``high`` answers every segment's
    start; a second sort by end answers its end. n log n per show, no product of segments and intervals.
    Segments with a null start or end are judged on the bound they have; intervals with a null bound
    or a null key count for nothing, as in the join.
    """
    columns = segments.columns
    bounds = intervals.where(F.col(key).isNotNull() & F.col("low").isNotNull() & F.col("high").isNotNull()).select(
        F.col(key), F.col("low").cast("double").alias("at"), F.lit(0).alias("kind"), F.col("high").cast("double").alias("high")
    )

    def covered(rows: DataFrame, point: str, flag: str) -> DataFrame:
        placed = rows.select(*columns, *(c for c in rows.columns if c not in columns), F.col(point).cast("double").alias("at"), F.lit(1).alias("kind"))
        together = placed.unionByName(bounds, allowMissingColumns=True)
        reach = F.max("high").over(
            Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        swept = together.withColumn(flag, F.coalesce(reach >= F.col("at"), F.lit(False)))
        return swept.where(F.col("kind") == 1).drop("at", "kind", "high")

    starts = covered(segments, "start_ms", "start_in")
    both = covered(starts, "end_ms", "end_in")
    return both.where(~F.col("start_in") & ~F.col("end_in")).select(*columns)
