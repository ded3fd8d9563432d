import math
import random

from captide.llm import hard_negatives as H


def brute_force(rows):
    """rows: (vec_id, vector, label) -> the contract's result by scoring every anchor with every row."""
    clean = []
    for vid, vec, label in rows:
        if vid is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vid % 7 == 0 else label
        clean.append((vid, label, [math.floor(256 * float(x)) if math.isfinite(256 * float(x)) else int(x) * 256 for x in vec]))

    def dot(a, b):
        return min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1)

    out = []
    for aid, alabel, aq in clean:
        if aid % 100:
            continue
        scored = sorted(((-dot(aq, q), vid, label) for vid, label, q in clean if vid != aid))
        positives = [(vid, -s) for s, vid, label in scored if label == alabel][:5]
        for pid, ps in positives:
            negs = [(vid, -s) for s, vid, label in scored if label != alabel and 30 * ps <= 100 * -s <= 90 * ps][:10]
            out += [(aid, pid, k + 1, nid, ps, ns) for k, (nid, ns) in enumerate(negs)]
    return sorted(out)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for vid in range(0, 1500):
        vec = [rnd.gauss(0, 0.2) for _ in range(16)]
        rows.append((vid, vec, rnd.randrange(3)))
    rows += [(3000, [0.1] * 16, 1), (3100, [0.1] * 16, 1), (3001, [0.1] * 16, 2), (3200, None, 1), (3300, [float("nan")] * 16, 1),
             (3400, [0.5, None] + [0.0] * 14, 1), (3500, [], 0), (None, [0.3] * 16, 1), (3600, [0.2] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    # Spark stores floats: score the same float values
    stored = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = sorted(tuple(r) for r in H.mine(df).collect())
    assert got == brute_force(stored)
    assert len(got) > 0


def test_huge_components_are_exact(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [3e29, 0.0], 2), (3, [2e29, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in H.mine(df).collect())
    assert got == brute_force(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert H.mine(df).count() == 0
