"""Quality rules against plain Python and against their SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from captide.llm import oracles, quality


def plain(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [line for line in text.split("\n") if line.encode().split()]
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def fixture(spark, n):
    rng = random.Random(n)
    vocabulary = ["the", "of", "né", "a#b", "|", "x", "日本", "🙂", "and", *(f"w{i}" for i in range(60))]
    rows = [(0, None, "en", "s"), (1, "", None, None), (2, " \n\t ", "en", None), (3, "a a a a", "en", "s"), (4, "a b c a b c", "en", "s")]
    rows += [(5, "w " * 3000, "en", "s"), (6, "x\x0by\x0cz \xa0 q", "en", "s"), (6, "x\x0by\x0cz \xa0 q", "en", "s")]
    for i in range(7, n):
        words = rng.choices(vocabulary, k=rng.choice([3, 60, 120, 400]))
        text = "".join(w + rng.choice([" ", " ", "  ", "\n"]) for w in words)
        if i % 11 == 0:
            text = "\n".join(["one line of words that is said again"] * 9 + [text])
        if i % 13 == 0:
            text = text.replace(" ", "### ")
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["s", "s", f"s{i % 4}"])))
    return spark.createDataFrame([(*r, "clash", i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, high string, row int")


@pytest.mark.parametrize("group_rows", [5, 10**6])
def test_counts_and_verdicts(spark, monkeypatch, group_rows):
    monkeypatch.setattr(quality, "GROUP_ROWS", group_rows)
    docs = fixture(spark, 300)
    got = quality.judge(docs).collect()
    assert len(got) == docs.count()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row in got:
        assert tuple(row.quality[n] for n in names) == plain(row.text), row.text
        assert row.quality.base_failed == (row.quality.n_words < 50 or 2 * row.quality.n_repeat_words > row.quality.n_words)
        assert row.high == "clash"
    verdicts = Counter((r.quality.base_failed, r.quality.kept) for r in got)
    assert verdicts[False, True] > 100 and verdicts[False, False] > 5 and not verdicts[True, True]

    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    sql = oracles.QUALITY_SQL.replace("rows >= 200", f"rows >= {group_rows}")
    expected = sorted(db.execute(sql).fetchall())
    assert sorted((r.doc_id, *(r.quality[n] for n in names), r.quality.base_failed, r.quality.kept) for r in got) == expected


def test_empty_table(spark):
    docs = fixture(spark, 20).limit(0)
    assert quality.judge(docs).collect() == []
    assert quality.judge(docs, carry=["doc_id"]).columns == ["doc_id", "quality"]


def test_sketch_bounds_the_error(spark):
    values = spark.range(0, 200000, 7).select(quality.bucket_floor(quality.bucket(quality.F.col("id"))).alias("low"), "id")
    assert values.where("low > id OR id - low > id / 32").count() == 0
