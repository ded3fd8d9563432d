import hashlib
import random

from captide.llm import substring_dedup as S


def brute_force(rows):
    docs = [(d, (t or "").split()) for d, t in rows]
    out = []
    for d, words in docs:
        removed = [False] * len(words)
        for i in range(len(words) - 12):
            seq = words[i : i + 13]
            if any(
                d is not None and e is not None and e < d and any(w[j : j + 13] == seq for j in range(len(w) - 12))
                for e, w in docs
            ):
                for k in range(i, i + 13):
                    removed[k] = True
        kept = " ".join(w for w, r in zip(words, removed) if not r)
        out.append((d, len(words), sum(removed), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(30)]
    passage = " ".join(rnd.choice(vocab) for _ in range(40))
    rows = []
    for d in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 80))]
        if d % 4 == 0:
            cut = rnd.randint(0, len(words))
            words[cut:cut] = passage.split()[rnd.randint(0, 10) : rnd.randint(20, 40)]
        rows.append((d, "\t ".join(words)))
    rows += [(100, None), (101, ""), (102, passage), (102, passage), (None, passage), (103, "x " * 5000 + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    got = sorted((tuple(r) for r in S.remove_repeats(df).collect()), key=repr)
    assert got == brute_force(rows)


def test_automaton_finds_every_window():
    rnd = random.Random(2)
    refs = [[rnd.randrange(5) for _ in range(200)] for _ in range(3)]
    automaton = S.SuffixAutomaton()
    for k, ids in enumerate(refs):
        for x in ids:
            automaton.extend(x, k)
        automaton.extend(-1 - k, k)
    smallest = automaton.finish(4)
    probe = [rnd.randrange(5) for _ in range(300)]
    spans = S.covered_spans(automaton, smallest, probe, 2, 4)
    covered = set()
    for i in range(len(probe) - 3):
        seq = probe[i : i + 4]
        if any(any(r[j : j + 4] == seq for j in range(len(r) - 3)) for r in refs[:2]):
            covered.update(range(i, i + 4))
    assert {p for s, e in spans for p in range(s, e)} == covered


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(df).count() == 0


def test_window_hashes(monkeypatch):
    monkeypatch.setattr(S, "PORTION", 40)
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["a", "b", "long" * 900], k=rng.choice([0, 3, 12, 13, 14, 52, 200]))).encode() for _ in range(60)]
    texts += [texts[-1].replace(b" ", b"\x0b\t"), b"a" * 13, "x\xa0y ".encode() * 13]
    found = [(o, h) for owners, hashes in S.window_hashes(texts) for o, h in zip(owners.tolist(), hashes.tolist())]
    windows = [(o, tuple(w[i : i + 13])) for o, w in enumerate(t.split() for t in texts) for i in range(len(w) - 12)]
    assert [o for o, _ in found] == [o for o, _ in windows]
    named = {}
    assert all(named.setdefault(w, h) == h for (_, w), (_, h) in zip(windows, found))
    assert len(set(named.values())) == len(named)
