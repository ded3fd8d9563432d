"""The Jaccard join against comparing all pairs of sets."""

import random

import numpy as np
import pytest

from captide.llm import ngram_join
from captide.llm.components import Forest, components


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_join(rows):
    sets = {}
    for i, text in rows:
        sets.setdefault(plain_set(text), []).append(i)
    forest, keys = Forest(), [k for k in sets if k]
    for key in keys:
        for i in sets[key]:
            forest.union(i, sets[key][0])
    for a in range(len(keys)):
        for b in range(a):
            common = len(keys[a] & keys[b])
            if 100 * common >= 80 * len(keys[a] | keys[b]):
                forest.union(sets[keys[a]][0], sets[keys[b]][0])
    return sorted((i, len(plain_set(t)), forest.find(i)) for i, t in rows)


def corpus(seed, n, edits):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and to in Is for On".split()) if rng.random() < 0.3 else f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(30)]
    base = [word() for _ in range(120)]
    rows = [(900001, None), (900002, ""), (900003, " \n\t"), (900004, "one two"), (900005, "One  TWO"), (900006, "one two three"), (900007, "É a b c d"), (900008, "é a b c d")]
    rows += [(900009, "long " * 20000), (900010, "long " * 25000)]
    for i in range(n):
        kind = rng.random()
        if kind < 0.35:
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(len(words))] = word()
        elif kind < 0.6 and len(rows) > 30:
            words = (rng.choice(rows[10:])[1] or "").split()
            for _ in range(rng.randrange(4)):
                if words:
                    words[rng.randrange(len(words))] = word()
        else:
            words = [word() for _ in range(rng.choice([2, 8, 40, 150]))]
            if kind > 0.85:
                words += passage
        rows.append((i * 7 % 100003, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,edits,block,roomy", [(1, 9, 1024, 16), (2, 9, 20, 3), (3, 16, 10, 1), (4, 3, 8, 1000)])
def test_join_against_all_pairs(spark, monkeypatch, seed, edits, block, roomy):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "ROOMY", roomy)
    rows = corpus(seed, 400, edits)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, n int").repartition(5)
    got = sorted(tuple(r) for r in ngram_join.join_documents(docs).collect())
    assert got == plain_join(rows)


def test_levels_change_nothing(spark, monkeypatch):
    rows = corpus(5, 200, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngram_join.sets_of

    def levelled(texts):
        sets, level = found(texts)
        return sets, np.random.default_rng(1).integers(0, 3, len(level)).astype(np.uint8)

    monkeypatch.setattr(ngram_join, "sets_of", levelled)
    assert sorted(tuple(r) for r in ngram_join.join_documents(docs).collect()) == plain_join(rows)


def test_empty_and_lonely(spark):
    docs = spark.createDataFrame([(5, None), (5, None), (6, "a")], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.join_documents(docs).collect()) == [(5, 0, 5), (5, 0, 5), (6, 1, 6)]
    assert ngram_join.join_documents(docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(200)] + [(3, 3), (None, 1)]
    edges += [(2000, 2000 + i) for i in range(300)]
    forest = Forest()
    for u, v in edges:
        if u is not None:
            forest.union(u, v)
    got = components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()
    expected = {x: forest.find(x) for e in edges if None not in e and e[0] != e[1] for x in e}
    assert {r.node: r.component for r in got} == expected and len(got) == len(expected)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
