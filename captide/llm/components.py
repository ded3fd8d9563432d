"""Connected components of a graph of links, by alternating large and small stars.

Each round is a few joins and aggregates over the edge table, written to shared storage; nothing is gathered in
one task or on the driver but counts, and graphs of at most ``FEW_EDGES``, which one task connects at once. Minima are combined
map-side, so a hub with a third of all edges is fine.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import staged

MAX_ROUNDS = 60


class Forest:
    """Union-find over any keys; the smallest key of a set is its root."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        parent = self.parent
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


FLUSH = 1 << 18
FEW_EDGES = 1 << 19


def _locally(batches):
    """Replace the edges that one task sees by stars with the same components, piece by piece."""
    yield from _stars(batches, FLUSH)


def _at_once(batches):
    """Stars of all edges; the smallest node of each is its centre."""
    yield from _stars(batches, 2 * FEW_EDGES)


def _stars(batches, flush: int):
    forest = Forest()

    def stars():
        pairs = [(x, forest.find(x)) for x in list(forest.parent)]
        pairs = [(x, root) for x, root in pairs if x != root]
        forest.parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], kind) for k in (0, 1)], names=["u", "v"])

    kind = None
    for batch in batches:
        kind = batch.schema.field("u").type
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            forest.union(u, v)
        if len(forest.parent) > flush:
            yield stars()
    if forest.parent:
        yield stars()


def components(edges: DataFrame, first: str = "u", second: str = "v") -> DataFrame:
    """``node, component``: every node of an edge with the smallest node it is connected with.

    Edges may be repeated, in either direction, or loops; rows with a null end are no edges. The two columns need
    one type that has an order. An empty table gives no rows.
    """
    kind = edges.schema[first].dataType.simpleString()
    pairs = edges.select(F.col(first).alias("u"), F.col(second).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    current = staged(pairs.mapInArrow(_locally, f"u {kind}, v {kind}").distinct(), "edges")
    if current.count() <= FEW_EDGES:
        current = staged(current.coalesce(1).mapInArrow(_at_once, f"u {kind}, v {kind}"), "stars")
    else:
        current = _by_rounds(current)
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _by_rounds(current: DataFrame) -> DataFrame:
    """Stars of staged edges ``u, v``; the smallest node of each is its centre."""
    before = None
    for _ in range(MAX_ROUNDS):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("hub")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), "m")
        hung = large.join(least, F.col("u") == F.col("hub"))
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("hub").alias("u"), F.col("m").alias("v")))
        current = staged(small.distinct(), "small-stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return current
        before = state
    raise RuntimeError(f"the components are not found after {MAX_ROUNDS} rounds")
