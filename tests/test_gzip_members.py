import gzip
import random

import pytest

from captide.sources import corpus, gzip_members


def _members(tmp_path, texts, name="a.csv.gz"):
    folder = tmp_path / "g"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"".join(gzip.compress(t) for t in texts))
    return str(folder)


def test_records_across_members_equal_a_sequential_read(spark, tmp_path):
    # Members cut inside records, inside quoted cells and right after quotes.
    text = b'x,y\n1,"a\nb"\n2,"c ""q"""\n3,\n4,"end"\n'
    rnd = random.Random(4)
    for trial in range(5):
        cuts = sorted(rnd.sample(range(1, len(text)), rnd.randint(1, 8)))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        folder = _members(tmp_path / str(trial), pieces) if (tmp_path / str(trial)).mkdir() is None else None
        got = sorted(map(tuple, gzip_members.read_gzip_csv(spark, folder, ["x", "y"], range_bytes=7).collect()))
        assert got == [("1", "a\nb"), ("2", 'c "q"'), ("3", None), ("4", "end")], pieces


def test_index_follows_the_chain(spark, tmp_path):
    # A member whose content is itself gzip data: its magic bytes lie inside, and must not count.
    inner = gzip.compress(b"not a member of the outer file")
    folder = _members(tmp_path, [b"a,b\n", gzip.compress(b"x") * 0 + b"1,2\n", inner, b"", b"3,4\n"])
    members = gzip_members.index_members(spark, folder, range_bytes=5).orderBy("member").collect()
    assert [m["member"] for m in members] == [0, 1, 2, 3, 4]
    assert [m["inflated"] for m in members] == [4, 4, len(inner), 0, 4]


def test_many_tasks_and_spark_agree(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(str(i), rnd.choice(["en", None]), "".join(rnd.choice(['a', '"', "\n", ",", "é"]) for _ in range(rnd.randint(1, 60)))) for i in range(500)]
    df = spark.createDataFrame(rows, "identifier string, lang string, text string").repartition(2)
    folder = str(tmp_path / "w")
    written = gzip_members.write_gzip_members(df, folder, ["identifier", "lang", "text"]).collect()
    assert sum(r["rows"] for r in written) == 500
    got = gzip_members.read_gzip_csv(spark, folder, ["identifier", "lang", "text"], range_bytes=1024)
    whole = corpus.read_corpus(spark, folder, ["identifier", "lang", "text"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) == sorted(rows)


def test_not_gzip_is_an_error(spark, tmp_path):
    folder = tmp_path / "n"
    folder.mkdir()
    (folder / "a.gz").write_bytes(b"plain text, no gzip\n")
    with pytest.raises(Exception):
        gzip_members.read_gzip_csv(spark, str(folder), ["a", "b"]).collect()
