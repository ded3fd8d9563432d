"""Decontamination against comparing every window with every item."""

import random

import numpy as np
import pytest

from captide.llm import decontaminate as d


def brute(docs, items):
    """Best window of every pair whose window is similar enough and within the radius."""
    out = {}
    for doc_id, text in docs:
        codes, sizes = d.read(text)
        h, w = d.shingled(codes, sizes)
        for item_id, item_text in items:
            c, s = d.read(item_text)
            ih, iw = d.shingled(c, s)
            if not len(ih):
                continue
            own, n = dict(zip(ih.tolist(), iw.tolist())), len(c)
            mark = d.fingerprints(c, np.zeros(1, np.int64), n)[0]
            best = None
            for start in range(len(codes) - n + 1):
                window = dict(zip(h[start : start + n - 4].tolist(), w[start : start + n - 4].tolist()))
                common = sum(x for k, x in window.items() if k in own)
                union = sum(own.values()) + sum(window.values()) - common
                near = np.bitwise_count(d.fingerprints(codes, np.array([start]), n)[0] ^ mark) <= d.RADIUS
                if 100 * common >= 80 * union and near and (best is None or common / union > best[2]):
                    best = (start, n, common / union)
            if best:
                out[doc_id, item_id] = best
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and a in".split()) if rng.random() < 0.3 else f"w{rng.randrange(500)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([5, 12, 40, 41, 60])))) for k in range(25)]
    items += [(100, items[3][1]), (101, "too short"), (102, ""), (103, None), (104, " ".join(["echo"] * 30))]
    docs = [(0, None), (1, ""), (2, "w1"), (3, "echo " * 5000)]
    for i in range(4, 90):
        words = [word() for _ in range(rng.choice([3, 30, 200]))]
        if i % 2:
            leak = rng.choice(items[:25])[1].split()
            for _ in range(rng.randrange(3)):
                leak[rng.randrange(len(leak))] = word()
            at = rng.randrange(len(words))
            leak = [x.upper() + rng.choice(["", ",", "!\n"]) for x in leak]
            words[at:at] = leak
        docs.append((i, " ".join(words)))
    return docs, items


def frames(spark, docs, items):
    left = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, start string, item_id int").repartition(3)
    return left, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("portion", [8 * 1024 * 1024, 700])
def test_against_every_window(spark, monkeypatch, portion):
    monkeypatch.setattr(d, "PORTION", portion)
    docs, items = corpus(portion)
    left, right = frames(spark, docs, items)
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity) for r in d.find_leaks(left, right).collect()}
    assert got == brute(docs, items) and len(got) > 15
    kept = {r.doc_id for r in d.clean(left, right).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in got}


def test_exact_passages_are_found():
    docs, items = corpus(9)
    search = d.Items(items[:25])
    for k, text in items[:25]:
        assert (k, 3) in {(f[0], f[1]) for f in search.found_in("some words before " + text + " and after")}


def test_index_meets_all_within_the_radius():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 200, dtype=np.uint64)
    asked = values[rng.integers(0, 200, 500)].copy()
    for k in range(500):
        for bit in rng.choice(64, rng.integers(0, 16), replace=False):
            asked[k] ^= np.uint64(1 << int(bit))
    left, right = d.HammingIndex(values).within(asked)
    expected = np.argwhere(np.bitwise_count(asked[:, None] ^ values[None, :]) <= d.RADIUS)
    assert sorted(zip(left.tolist(), right.tolist())) == sorted(map(tuple, expected.tolist()))


def test_empty_tables(spark):
    left, right = frames(spark, [(1, "a b c d e f")], [(1, "a b c d e")])
    assert d.find_leaks(left.limit(0), right).collect() == []
    assert d.find_leaks(left, right.limit(0)).collect() == []
    assert d.clean(left, right.limit(0)).count() == 1
    assert [(r.doc_id, r.item_id, r.start) for r in d.find_leaks(left, right).collect()] == [(1, 1, 0)]
