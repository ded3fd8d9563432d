"""Quality rules whose thresholds come from the corpus: quantile sketches per language and source.

A sketch is a histogram over buckets that grow with the value: below 64 a bucket is one value, above that each
power of two has 32 buckets, so a quantile is off by 1/32 of its value at most. Sketches are merged by adding
counts: the sketch of a language is the sum over its sources. They are plain aggregates, computed map-side first,
so a source with a third of all rows costs no more than any other, and thresholds do not depend on the order of
rows. Everything is made of DataFrame and SQL functions.

A document is rejected if a measure lies outside the fences of its language and source: 3 interquartile ranges
plus ``SLACK`` beyond the quartiles. Groups of fewer than ``GROUP_ROWS`` documents use the sketch of their language,
languages of fewer the sketch of everything. A source's fence reaches at most twice as far as its language's, so a
source of junk alone does not set its own standard.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captide.llm.common import staged

WHITE = r"[\x20\x09-\x0D]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
GROUP_ROWS = 200
# Measures are in thousandths. The slack is the smallest distance that counts as an outlier.
SLACK = {"symbol_rate": 100, "repeat_rate": 300, "dup_line_rate": 350, "word_length": 1000}
TWO_SIDED = ("word_length",)
MEASURES = tuple(SLACK)
SALTS = 16


def repeated_words(words: str) -> str:
    """SQL for the number of words in 3-word windows that an array of words holds twice or more.

    Windows are sorted by hash with their positions, so the cost is n log n for texts of any length; each array
    is bound to a lambda variable, as it is used more than once.
    """
    hashes = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    same = "coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false)"
    starts = f"sort_array(transform(filter(s, (x, k) -> {same}), x -> x.i))"
    covered = (
        "aggregate(p, named_struct('last', -3, 'n', 0),"
        " (a, i) -> named_struct('last', i, 'n', a.n + least(3, i - a.last)), a -> a.n)"
    )
    by_start = f"transform(array({starts}), p -> {covered})[0]"
    by_hash = f"transform(array(sort_array(transform(h, (v, i) -> named_struct('h', v, 'i', i)))), s -> {by_start})[0]"
    counted = f"transform(array({hashes}), h -> IF(size(array_distinct(h)) = size(h), 0, {by_hash}))[0]"
    return f"transform(array({words}), w -> IF(size(w) < 6 AND size(array_distinct(w)) = size(w) OR size(w) < 3, 0, {counted}))[0]"


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with a struct ``quality`` of counts (long) over the whole text; a null text has none.

    A column ``quality`` of the input is replaced.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    bare = F.regexp_replace(text, f"^{WHITE}+|{WHITE}+$", "")
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{WHITE}+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(rf"[^\x20\x09-\x0D]"))
    split = docs.withColumn("quality", F.struct(text.alias("t"), words.alias("w"), lines.alias("l")))
    counts = {
        "n_words": F.size("quality.w"),
        "word_chars": F.char_length(F.array_join("quality.w", "")),
        "n_symbols": F.char_length(F.regexp_replace("quality.t", r"[^#*$%&|<>]+", "")),
        "n_lines": F.size("quality.l"),
        "n_dup_lines": F.size("quality.l") - F.size(F.array_distinct("quality.l")),
        "n_repeat_words": F.expr(repeated_words("quality.w")),
    }
    return split.withColumn("quality", F.struct(*(c.cast("bigint").alias(name) for name, c in counts.items())))


def base_failed(counts: Column) -> Column:
    """The two fixed rules that come before any threshold."""
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"])


def rates(counts: Column) -> dict[str, Column]:
    """The measures in thousandths; null without words."""
    words = F.when(counts["n_words"] > 0, counts["n_words"])
    of = lambda part, whole: F.call_function("div", part * 1000, whole)
    return {
        "symbol_rate": of(counts["n_symbols"], words),
        "repeat_rate": of(counts["n_repeat_words"], words),
        "dup_line_rate": of(counts["n_dup_lines"], F.when(counts["n_lines"] > 0, counts["n_lines"])),
        "word_length": of(counts["word_chars"], words),
    }


def bucket(value: Column) -> Column:
    """The sketch bucket of a count."""
    shift = F.char_length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(shift * 32 + F.call_function("shiftright", value, shift)).cast("bigint")


def bucket_floor(number: Column) -> Column:
    """The smallest value of a bucket."""
    shift = F.floor(number / 32).cast("int") - 1
    return F.when(number < 64, number).otherwise(F.call_function("shiftleft", number - shift * 32, shift)).cast("bigint")


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, measure, bucket, n``: the sketch of every measure of every group."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES)))
    return rows.select(*keys, values.alias("v")).select(*keys, "v.*").groupBy(*keys, "measure", "bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, measure, rows, low, high`` from the quartiles of each sketch."""
    group = Window.partitionBy(*keys, "measure")
    running = sketch.withColumns(
        {
            "rows": F.sum("n").over(group),
            "upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    quartile = lambda q: bucket_floor(F.min(F.when(4 * F.col("upto") >= q * F.col("rows"), F.col("bucket"))))
    slack = F.element_at(F.create_map(*(F.lit(x) for pair in SLACK.items() for x in pair)), F.col("measure"))
    reach = 3 * (F.col("q3") - F.col("q1")) + slack
    found = running.where("bucket IS NOT NULL").groupBy(*keys, "measure").agg(F.max("rows").alias("rows"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    return found.select(*keys, "measure", "rows", "q1", "q3", reach.alias("reach"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source, low, high``: structs with a bound per measure, for every group of the sketch."""
    merged = lambda keys: sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    own = fences(sketch, ["lang", "source"])
    named = lambda df, prefix: df.select(*df.columns[:-4], *(F.col(c).alias(f"{prefix}_{c}") for c in df.columns[-4:]))
    language = named(fences(merged(["lang"]), ["lang"]), "lang")
    everything = named(fences(merged([]), []), "all")
    o, g = own.alias("o"), language.alias("g")
    both = o.join(g, F.expr("o.lang <=> g.lang AND o.measure = g.measure")).select("o.*", *(f"g.lang_{c}" for c in ("rows", "q1", "q3", "reach")))
    both = both.join(everything, "measure")
    enough, language_enough = F.col("rows") >= GROUP_ROWS, F.col("lang_rows") >= GROUP_ROWS
    pick = lambda c: F.when(language_enough, F.col(f"lang_{c}")).otherwise(F.col(f"all_{c}"))
    wide_high, wide_low = pick("q3") + pick("reach"), pick("q1") - pick("reach")
    high = F.when(enough, F.least(F.col("q3") + F.col("reach"), 2 * wide_high)).otherwise(wide_high)
    low = F.when(enough, F.greatest(F.col("q1") - F.col("reach"), F.floor(wide_low / 2).cast("bigint"))).otherwise(wide_low)
    bound = lambda side, m: F.max(F.when(F.col("measure") == m, F.col(side))).alias(m)
    return (
        both.withColumns({"high": high, "low": low})
        .groupBy("lang", "source")
        .agg(F.struct(*(bound("high", m) for m in MEASURES)).alias("high"), F.struct(*(bound("low", m) for m in TWO_SIDED)).alias("low"))
    )


def judge(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the struct ``quality``: counts, ``base_failed``, measures and ``kept``; one row per row.

    A null or empty text has counts of 0 and fails the base rules. A null language or source is a group like any
    other. Repeated rows are judged alike. An empty table stays empty. Documents without thresholds (no document
    of the whole table passes the base rules) are kept if they pass these. Input columns stay as they are, but for
    one named ``quality``, which is replaced; ``carry`` names the columns wanted, all by default. Measured rows are
    staged once on shared storage.
    """
    columns = [c for c in (carry or docs.columns) if c.lower() != "quality"]
    q = F.col("quality")
    counted = F.struct("quality.*", base_failed(q).alias("base_failed"), *(c.alias(m) for m, c in rates(q).items()))
    # Salts deal a hot source out where the thresholds are too many to be broadcast.
    salt = F.pmod(F.xxhash64(F.col(text_column).cast("string")), F.lit(SALTS)).cast("int")
    group = F.struct(F.col(lang_column).cast("string").alias("lang"), F.col(source_column).cast("string").alias("source"), salt.alias("salt"))
    scored = measured(docs, text_column).select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), counted.alias("quality"), group.alias("group")
    )
    scored = staged(scored, "quality")
    passed = scored.where("NOT quality.base_failed").select("group.lang", "group.source", *(f"quality.{m}" for m in MEASURES))
    limits = staged(thresholds(sketches(passed, ["lang", "source"])), "quality-thresholds")
    limits = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    s, t = scored.alias("s"), limits.alias("t")
    # Spark broadcasts the stored thresholds if they are small.
    joined = s.join(t, F.expr("s.group.lang <=> t.lang AND s.group.source <=> t.source AND s.group.salt = t.salt"), "left")
    outside = [F.col(f"s.quality.{m}") > F.col(f"t.high.{m}") for m in MEASURES]
    outside += [F.col(f"s.quality.{m}") < F.col(f"t.low.{m}") for m in TWO_SIDED]
    failed = functools.reduce(lambda a, b: a | b, (F.coalesce(x, F.lit(False)) for x in outside))
    kept = ~F.col("s.quality.base_failed") & ~failed
    return joined.select("s.row.*", F.struct("s.quality.*", kept.alias("kept")).alias("quality"))
