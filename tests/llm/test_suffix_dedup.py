"""Removal of repeated strings against counting every window."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from captide.llm import suffix_dedup as d


def by_hand(rows, length):
    times = Counter()
    for _, text in rows:
        data = (text or "").encode()
        times.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if times[data[k : k + length]] > 1:
                gone[k : k + length] = True
        starts, ends = d.runs(gone)
        out.append((i, len(data), list(zip(starts.tolist(), ends.tolist())), bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def corpus(seed, length):
    rng = random.Random(seed)
    letters = "abé日 \n" if seed % 2 else "ab"
    fresh = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [fresh(n) for n in (length - 1, length, length + 1, 2 * length, 5 * length)]
    rows = [(0, None), (1, ""), (2, "a" * (length - 1)), (3, "a" * (3 * length)), (4, "ab" * length), (5, "x" + "ab" * length), (6, fresh(length))]
    for i in range(7, 60):
        text = fresh(rng.randrange(3 * length))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                at = rng.randrange(len(p))
                p = p[:at] + "Z" + p[at + 1 :]
            text = text[: rng.randrange(len(text) + 1)] + p + fresh(rng.randrange(length))
        rows.append((i, text))
    return rows + [rows[20], rows[20], (None, rows[21][1]), (7, "same id, other text" * 30)]


@pytest.mark.parametrize("seed,length,gram,group,batch", [(1, 400, 64, 1500, 1000), (2, 60, 8, 1500, 3), (3, 40, 6, 2, 1000), (4, 50, 12, 5, 10), (5, 30, 4, 1500, 50)])
def test_against_every_window(spark, monkeypatch, seed, length, gram, group, batch):
    for name, value in (("LENGTH", length), ("GRAM", gram), ("GROUP", group), ("BATCH", batch)):
        monkeypatch.setattr(d, name, value)
    rows = corpus(seed, length)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, body string").repartition(4)
    got = with_these_constants(d, frame)
    assert got == by_hand(rows, length)


def with_these_constants(module, frame):
    """The result with the module sent to the workers as it is now, not imported anew there."""
    cloudpickle.register_pickle_by_value(module)
    try:
        found = module.remove_repeats(frame).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(module)
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in found), key=repr)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert d.remove_repeats(frame).collect() == []


def test_suffix_order():
    rng = np.random.default_rng(1)
    for n in [*range(0, 40), 200, 1000]:
        for letters in (1, 2, 200):
            t = rng.integers(1, letters + 1, n)
            assert d.suffix_order(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())
    fibonacci = [1, 2]
    while len(fibonacci) < 900:
        fibonacci += fibonacci[: -len(fibonacci) // 3]
    assert d.suffix_order(np.array(fibonacci)).tolist() == sorted(range(len(fibonacci)), key=lambda i: fibonacci[i:])
