"""The first rows of a stated order, for small and for large numbers of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.session import staged
from captide.sources.identifiers import with_position

# Up to this many rows every task may send its own first rows to a single one.
TOP_ROWS = 10_000


def first_in_order(df: DataFrame, order_by: str, n: int, top_rows: int = TOP_ROWS) -> DataFrame:
    """The first ``n`` rows of ``df`` by one of its columns.

    A small ``n`` is Spark's top-k. With a large one the candidates of all tasks would
    meet in a single task, so the rows are counted and, if there are more than ``n``,
    written in sorted order and chosen by position, which keeps every step parallel.
    """
    if n <= top_rows:
        return df.orderBy(order_by).limit(n)
    if df.select(order_by).count() <= n:
        return df
    numbered = with_position(staged(df.orderBy(order_by), "sorted"), "__pos")
    return numbered.filter(F.col("__pos") < n).drop("__pos")


def preview(df: DataFrame, n: int, columns: list[str], order_by: str) -> DataFrame:
    """The first ``n`` rows in a stated order, with only the named columns."""
    ordered = df.select(*columns, F.col(order_by).alias("__order"))
    return first_in_order(ordered, "__order", n).drop("__order")


def row_at(df: DataFrame, n: int, columns: list[str], order_by: str) -> DataFrame:
    """The row at the zero-based position ``n`` of a stated order; none if there are fewer."""
    ordered = df.select(*columns, F.col(order_by).alias("__order"))
    if n < TOP_ROWS:
        return ordered.orderBy("__order").offset(n).limit(1).drop("__order")
    numbered = with_position(staged(ordered.orderBy("__order"), "sorted"), "__pos")
    return numbered.filter(F.col("__pos") == n).drop("__pos", "__order")
