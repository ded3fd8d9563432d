"""Hard-negative mining with LEMP-style pruning over length buckets.

Rows and scores: a row takes part if its id, label and vector are not null and every component is finite.
Where ``vec_id`` is divisible by ``RELABEL_EVERY`` the label first becomes ``(label + 1) % 10``. A component
``x`` becomes ``floor(256 * x)`` (``x`` as double); a score is the exact integer inner product of two such
vectors (over the positions both have; a shorter vector counts as padded with zeros). Higher scores come
first, ties by smaller ``vec_id``.

Anchors are rows whose ``vec_id`` is divisible by ``ANCHOR_EVERY``. An anchor's positives are its first
``POSITIVES`` other rows (other ``vec_id``) of the same label; for each anchor and positive with score ``p`` the
negatives are the first ``NEGATIVES`` rows of another label whose score ``n`` satisfies
``30 p <= 100 n <= 90 p`` (so none for ``p < 0``, and only scores of 0 for ``p = 0``).

How it runs:

1. The clean rows are range-partitioned by vector length (descending) and written once; every Arrow batch of a
   task then is a **length bucket**: a run of rows of similar length, with a known largest length ``L``.
2. Anchors are dealt out in portions of at most ``PORTION_BYTES``; a portion is broadcast and every task scans
   its buckets once for it. No vector is shuffled.
3. *Positives*: per anchor a running top list; a bucket is skipped for an anchor once ``|a| L`` falls below
   the score of its current ``POSITIVES``-th row (buckets come longest first). Lists of all tasks are merged by
   a window per anchor.
4. *Negatives*: the search threshold of an anchor is the least lower bound of its positives. A bucket whose
   ``|a| L`` is below it is skipped; otherwise the bucket's normalised vectors are held as one sorted list per
   coordinate, and for the anchor's focus coordinates (largest ``|a_f|``) the feasible range
   ``a_f t -+ sqrt((1 - a_f^2)(1 - t^2))`` with ``t = threshold / (|a| L)`` cuts a candidate set from each list
   by binary search; the sets are intersected and only the survivors are scored exactly. A threshold of 0 or
   less takes the whole bucket. Per (anchor, positive) a task keeps its first ``NEGATIVES``; a window merges.

Defined results: rows with a null id take no part; an empty vector scores 0 with everything; an anchor without
positives, or a positive without negatives in range, yields no rows; rows repeated under one id take part as
often as they stand (an anchor that stands twice yields its rows twice). Components so large that their
products leave 64 bits are scored with Python integers, exactly, and a score outside the range of a long is
then saturated at -2^63 or 2^63 - 1; ranking and the range test use that score. Extra columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from captide.llm.common import staged

ANCHOR_EVERY = 100
RELABEL_EVERY = 7
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
FOCUS = 3
ROWS_PER_TASK = 16_384
PORTION_BYTES = 32 * 1024 * 1024
_SAFE = 2**62
_LONG = (-(2**63), 2**63 - 1)


def _long(x) -> int:
    return min(max(int(x), _LONG[0]), _LONG[1])


def clean_rows(vectors: DataFrame, id_column="vec_id", vector_column="embedding", label_column="label") -> DataFrame:
    """``vec_id, label, emb`` of the rows that take part, with the label changed where the rule says."""
    vid, vec, label = F.col(id_column).cast("long"), F.col(vector_column), F.col(label_column).cast("int")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    relabel = F.when(vid % RELABEL_EVERY == 0, (label + 1) % 10).otherwise(label)
    length2 = F.aggregate("emb", F.lit(0.0), lambda acc, x: acc + (F.lit(256.0) * x) ** 2)
    return (
        vectors.where(vid.isNotNull() & label.isNotNull() & vec.isNotNull() & finite)
        .select(vid.alias("vec_id"), relabel.alias("label"), F.transform(vec, lambda x: x.cast("double")).alias("emb"))
        .withColumn("length", F.sqrt(length2))
    )


def _quantised(rows) -> tuple[np.ndarray, bool]:
    """floor(256 x) of ragged rows, zero padded; int64 when safe, else Python integers (object array)."""
    dim = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), dim), dtype=np.float64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = np.floor(np.asarray(r, dtype=np.float64) * 256.0)
    if np.isfinite(out).all() and (np.abs(out).max(initial=0) < 2**31):
        return out.astype(np.int64), True
    exact = np.zeros((len(rows), dim), dtype=object)
    for i, r in enumerate(rows):
        for j, x in enumerate(r):
            x = float(x)
            exact[i, j] = math.floor(x * 256.0) if math.isfinite(x * 256.0) else int(x) * 256
    return exact, False


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` with those of ``b``."""
    dim = max(a.shape[1], b.shape[1])
    if a.shape[1] < dim:
        a = np.pad(a, ((0, 0), (0, dim - a.shape[1])))
    if b.shape[1] < dim:
        b = np.pad(b, ((0, 0), (0, dim - b.shape[1])))
    if a.dtype == np.int64 and b.dtype == np.int64:
        bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(dim, 1)
        if bound < _SAFE:
            return a @ b.T
    exact = np.dot(a.astype(object), b.astype(object).T)
    return np.vectorize(_long, otypes=[np.int64])(exact) if exact.size else np.zeros(exact.shape, dtype=np.int64)


def _bucket_index(q: np.ndarray):
    """Normalised vectors of a bucket and, per coordinate, their order and sorted values."""
    v = q.astype(np.float64)
    norms = np.linalg.norm(v, axis=1)
    unit = np.divide(v, norms[:, None], out=np.zeros_like(v), where=norms[:, None] > 0)
    order = np.argsort(unit, axis=0, kind="stable")
    return norms, unit, order, np.take_along_axis(unit, order, axis=0)


def _candidates(anchor: np.ndarray, a_norm: float, threshold: int, top_length: float, index) -> np.ndarray | None:
    """Rows of a bucket that may reach ``threshold`` with ``anchor``; None for all of them."""
    if threshold <= 0:
        return None
    if a_norm == 0 or a_norm * top_length * (1 + 1e-9) < threshold:
        return np.zeros(0, dtype=np.int64)
    _, _, order, sorted_values = index
    t = min(1.0, threshold / (a_norm * top_length)) * (1 - 1e-9)
    unit = anchor.astype(np.float64) / a_norm
    dims = min(len(unit), order.shape[1])
    focus = np.argsort(-np.abs(unit[:dims]), kind="stable")[:FOCUS]
    chosen = None
    for f in focus:
        reach = math.sqrt(max(0.0, (1 - unit[f] ** 2) * (1 - t * t))) + 1e-9
        lo, hi = unit[f] * t - reach, unit[f] * t + reach
        left = np.searchsorted(sorted_values[:, f], lo, side="left")
        right = np.searchsorted(sorted_values[:, f], hi, side="right")
        rows = np.sort(order[left:right, f])
        chosen = rows if chosen is None else np.intersect1d(chosen, rows, assume_unique=True)
        if chosen.size == 0:
            break
    return chosen


def _first(scores: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``limit`` rows by score (descending), then id; ``~score`` orders without overflow."""
    order = np.lexsort((ids, ~scores))[:limit]
    return scores[order], ids[order]


def _merge(best, scores, ids, limit):
    if best is None:
        return _first(scores, ids, limit)
    return _first(np.concatenate([best[0], scores]), np.concatenate([best[1], ids]), limit)


def _in_range(scores: np.ndarray, p: int) -> np.ndarray:
    """``30 p <= 100 s <= 90 p`` for every score, exact also where 100 s leaves 64 bits."""
    if np.abs(scores).max(initial=0) < 2**56 and abs(p) < 2**56:
        hundred = 100 * scores
        return (LOW_PERCENT * p <= hundred) & (hundred <= HIGH_PERCENT * p)
    return np.array([LOW_PERCENT * p <= 100 * int(x) <= HIGH_PERCENT * p for x in scores], dtype=bool)


def _positive_search(portion):
    """mapInPandas over length buckets: per anchor of the portion, its best same-label rows in this task."""
    a_rid, a_id, a_label, a_q = portion
    a_norms = np.linalg.norm(a_q.astype(np.float64), axis=1)

    def run(batches):
        best = [None] * len(a_id)
        for batch in batches:
            if batch.empty:
                continue
            q, _ = _quantised(list(batch["emb"]))
            ids, labels = batch["vec_id"].to_numpy(np.int64), batch["label"].to_numpy(np.int64)
            top = float(np.linalg.norm(q.astype(np.float64), axis=1).max(initial=0.0))
            # A bucket whose longest row cannot beat an anchor's current last positive is skipped for it.
            live = [
                i for i, b in enumerate(best) if b is None or len(b[0]) < POSITIVES or a_norms[i] * top * (1 + 1e-9) >= b[0][-1]
            ]
            if not live:
                continue
            scores = _scores(a_q[live], q)
            for row, i in enumerate(live):
                mask = (labels == a_label[i]) & (ids != a_id[i])
                if mask.any():
                    best[i] = _merge(best[i], scores[row][mask], ids[mask], POSITIVES)
        out = [(a_rid[i], int(v), _long(s)) for i, b in enumerate(best) if b is not None for s, v in zip(*b)]
        yield pd.DataFrame(out, columns=["rid", "positive_id", "positive_score"]).astype("int64")

    return run


def _negative_search(portion):
    """mapInPandas over length buckets: per (anchor, positive), its best other-label rows in range here."""
    a_rid, a_id, a_label, a_q, positives = portion
    a_norms = np.linalg.norm(a_q.astype(np.float64), axis=1)
    thresholds = [min((-(-LOW_PERCENT * p // 100) for _, p in pos if p >= 0), default=None) for pos in positives]

    def run(batches):
        best = {}
        for batch in batches:
            if batch.empty:
                continue
            q, _ = _quantised(list(batch["emb"]))
            ids, labels = batch["vec_id"].to_numpy(np.int64), batch["label"].to_numpy(np.int64)
            index = _bucket_index(q)
            top = float(index[0].max(initial=0.0))
            for i, threshold in enumerate(thresholds):
                if threshold is None:
                    continue
                rows = _candidates(a_q[i], a_norms[i], threshold, top, index)
                if rows is None:
                    rows = np.arange(len(ids))
                rows = rows[labels[rows] != a_label[i]]
                if rows.size == 0:
                    continue
                scores = _scores(a_q[i : i + 1], q[rows])[0]
                for k, (_, p) in enumerate(positives[i]):
                    ok = _in_range(scores, p)
                    if ok.any():
                        best[(i, k)] = _merge(best.get((i, k)), scores[ok], ids[rows][ok], NEGATIVES)
        out = [
            (a_rid[i], positives[i][k][0], _long(positives[i][k][1]), int(v), _long(s))
            for (i, k), b in best.items()
            for s, v in zip(*b)
        ]
        yield pd.DataFrame(out, columns=["rid", "positive_id", "positive_score", "negative_id", "negative_score"]).astype("int64")

    return run


_POS = T.StructType([T.StructField(c, T.LongType()) for c in ("rid", "positive_id", "positive_score")])
_NEG = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("rid", "positive_id", "positive_score", "negative_id", "negative_score")]
)


def _portions(rows: DataFrame, columns: list[str]):
    """The anchor rows in portions of about ``PORTION_BYTES``, dealt by a hash, fetched one portion at a time."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*columns)))), F.lit(0))).first()[0]
    n_parts = max(1, -(-int(size) // PORTION_BYTES))
    part = F.pmod(F.xxhash64("rid"), F.lit(n_parts))
    for k in range(n_parts):
        chunk = rows.where(part == k).select(*columns).collect()
        if chunk:
            yield chunk


def mine(vectors: DataFrame, **columns) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; see the module text."""
    spark = vectors.sparkSession
    clean = clean_rows(vectors, **columns)
    n_rows = clean.count()
    tasks = max(1, -(-n_rows // ROWS_PER_TASK))
    buckets = staged(
        clean.repartitionByRange(tasks, F.col("length").desc(), "vec_id").sortWithinPartitions(F.col("length").desc()),
        "negatives-buckets",
    )
    anchors = staged(
        buckets.where(F.col("vec_id") % ANCHOR_EVERY == 0).withColumn("rid", F.monotonically_increasing_id()),
        "negatives-anchors",
    )
    scan = buckets.select("vec_id", "label", "emb")

    found = []
    for portion in _portions(anchors, ["rid", "vec_id", "label", "emb"]):
        q, _ = _quantised([r["emb"] for r in portion])
        payload = ([r["rid"] for r in portion], np.array([r["vec_id"] for r in portion]), [r["label"] for r in portion], q)
        found.append(scan.mapInPandas(_positive_search(payload), _POS))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    first = Window.partitionBy("rid").orderBy(F.col("positive_score").desc(), "positive_id")
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    positives = staged(
        candidates.withColumn("n", F.row_number().over(first)).where(F.col("n") <= POSITIVES).drop("n"), "negatives-positives"
    )

    queries = anchors.join(
        positives.groupBy("rid").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")), "rid"
    )
    mined = []
    for portion in _portions(queries, ["rid", "vec_id", "label", "emb", "positives"]):
        q, _ = _quantised([r["emb"] for r in portion])
        pos = [[(int(p["positive_id"]), int(p["positive_score"])) for p in r["positives"]] for r in portion]
        payload = ([r["rid"] for r in portion], np.array([r["vec_id"] for r in portion]), [r["label"] for r in portion], q, pos)
        mined.append(scan.mapInPandas(_negative_search(payload), _NEG))
    if not mined:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    negatives = mined[0]
    for more in mined[1:]:
        negatives = negatives.unionByName(more)
    order = Window.partitionBy("rid", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = negatives.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return ranked.join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
