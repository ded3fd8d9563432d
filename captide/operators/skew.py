"""Equi-joins that stay balanced when a few keys hold a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.session import broadcast_if_small, staged

# A key counts as heavy from this many rows on; shows carry whole caption texts.
HEAVY_ROWS = 20_000


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> dict:
    """Keys with at least ``heavy_rows`` rows and their counts.

    One scan of the key column and a count that is combined before its shuffle. The
    driver gets the heavy keys alone, one for ``heavy_rows`` rows at most.
    """
    counts = df.groupBy(F.col(f"`{key}`").alias("key")).count()
    heavy = counts.where(F.col("key").isNotNull() & (F.col("count") >= heavy_rows))
    return {row["key"]: row["count"] for row in heavy.collect()}


def _salt_counts(counts: dict, heavy_rows: int) -> dict:
    """Number of salts per key: one for each ``heavy_rows`` rows."""
    return {key: -(-n // heavy_rows) for key, n in counts.items()}


def _salts(key: str, counts: dict, heavy_rows: int) -> Column:
    literals = [F.lit(part) for pair in _salt_counts(counts, heavy_rows).items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*literals), F.col(key)), F.lit(1)).cast("bigint")


def salted(df: DataFrame, key: str, counts: dict, heavy_rows: int, salt: str) -> DataFrame:
    """Give each row of a heavy key one of its salts, 0 to all other rows.

    Salts follow the row number within the task, so copies of a row are spread
    too. The input comes from files, so a repeated task gives the same salts.
    """
    if not counts:
        return df.withColumn(salt, F.lit(0).cast("bigint"))
    return df.withColumn(salt, F.pmod(F.monotonically_increasing_id(), _salts(key, counts, heavy_rows)))


def _replicated(df: DataFrame, key: str, counts: dict, heavy_rows: int, salt: str) -> DataFrame:
    """Repeat each row of a key that is heavy on the other side, once per salt."""
    if not counts:
        return df.withColumn(salt, F.lit(0).cast("bigint"))
    last = _salts(key, counts, heavy_rows) - 1
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    right_is_unique: bool = False,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Join on ``key`` (``inner`` or ``left``) where keys may repeat without bound.

    Without heavy keys this is the plain join. Otherwise the rows of heavy keys are
    joined apart, because one small row may have to meet very many others: the size
    of the input, which adaptive execution looks at, does not show that. Keys heavy
    on the left only are dealt out evenly and meet a broadcast of their few right
    rows if these are small. In all other cases the join is on the key and a salt for
    each side it is heavy on, in a given number of tasks, so that the short rows are
    not gathered again. The parts are disjoint in the key, so their union is the whole
    result. Semi and anti joins have no such growth and are left to adaptive skew
    handling.

    Inputs are read once for the counts, by their key alone, and once for each part:
    store what is costly to compute before joining it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left join expected, not {how!r}")
    left_heavy = heavy_keys(left, key, heavy_rows)
    right_heavy = {} if right_is_unique else heavy_keys(right, key, heavy_rows)
    if not left_heavy and not right_heavy:
        return left.join(right, key, how)

    def rows(df: DataFrame, counts) -> DataFrame:
        return staged(df.filter(F.col(key).isin(list(counts))), "heavy")

    def other_rows(df: DataFrame, counts) -> DataFrame:
        # NULL keys match nothing and stay on the plain side.
        return df.filter(~F.coalesce(F.col(key).isin(list(counts)), F.lit(False)))

    heavy = left_heavy | right_heavy
    parts = [other_rows(left, heavy).join(other_rows(right, heavy), key, how)]
    left_only = {k: n for k, n in left_heavy.items() if k not in right_heavy}
    if left_only:
        tasks = sum(_salt_counts(left_only, heavy_rows).values())
        near = rows(left, left_only)
        far, small = broadcast_if_small(rows(right, left_only))
        if small:
            cores = left.sparkSession.sparkContext.defaultParallelism
            parts.append(near.repartition(max(tasks, 2 * cores)).join(far, key, how))
        else:
            near = salted(near, key, left_only, heavy_rows, "__ls").repartition(tasks, key, "__ls")
            far = _replicated(far, key, left_only, heavy_rows, "__ls")
            parts.append(near.join(far, [key, "__ls"], how).drop("__ls"))
    if right_heavy:
        # These keys exist on the right, so an outer join has nothing to fill in.
        both = {k: n for k, n in left_heavy.items() if k in right_heavy}
        near = salted(rows(left, right_heavy), key, both, heavy_rows, "__ls")
        near = _replicated(near, key, right_heavy, heavy_rows, "__rs")
        far = salted(rows(right, right_heavy), key, right_heavy, heavy_rows, "__rs")
        far = _replicated(far, key, both, heavy_rows, "__ls")
        of_left = _salt_counts(both, heavy_rows)
        tasks = sum(n * of_left.get(k, 1) for k, n in _salt_counts(right_heavy, heavy_rows).items())
        cells = [key, "__ls", "__rs"]
        parts.append(near.repartition(tasks, *cells).join(far, cells, "inner").drop("__ls", "__rs"))
    return reduce(DataFrame.unionByName, parts)
