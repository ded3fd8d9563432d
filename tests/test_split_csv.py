import random

import pytest

from captide.sources import corpus, split_csv


def _write(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "identifier string, lang string, text string")
    path = str(tmp_path / "c")
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@pytest.mark.parametrize("range_bytes", [997, 1 << 30])
def test_ranges_give_the_rows_of_a_whole_file_read(spark, tmp_path, range_bytes):
    rnd = random.Random(range_bytes)
    pieces = ["a", "b", " ", '"', "\n", ",", "\r\n", "é", '""', "\t"]
    rows = [
        (str(i), rnd.choice(["en", "", None]), "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 200))) if i % 5 else None)
        for i in range(300)
    ]
    path = _write(spark, tmp_path, rows)
    split = split_csv.read_split_csv(spark, path, ["identifier", "lang", "text"], range_bytes=range_bytes)
    whole = corpus.read_corpus(spark, path, ["identifier", "lang", "text"])
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))


def test_records_are_cut_exactly_at_every_range_bound(tmp_path):
    data = b'a,b\n1,"x\ny"\n2,"""q"",\n"\n3,z\n'
    path = tmp_path / "f.csv"
    path.write_bytes(data)
    for size in range(1, len(data) + 1):
        inside, parts = False, []
        for start in range(0, len(data), size):
            end = min(len(data), start + size)
            with open(path, "rb") as f:
                parts.append(split_csv.own_records(f, start, end, len(data), inside))
            inside ^= bool(data[start:end].count(b'"') & 1)
        assert b"".join(parts) == data


def test_many_tasks_read_one_file(spark, tmp_path):
    rows = [(str(i), "en", "line\n" * 50) for i in range(2000)]
    path = _write(spark, tmp_path, rows)
    split = split_csv.read_split_csv(spark, path, ["identifier", "lang", "text"], range_bytes=16 * 1024)
    assert split.rdd.getNumPartitions() > 8
    assert split.count() == 2000


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_bytes(b"")
    (tmp_path / "e" / "b.csv").write_bytes(b"x,y\n")
    assert split_csv.read_split_csv(spark, str(tmp_path / "e"), ["x", "y"]).count() == 0


def test_wrong_cell_counts(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_bytes(b"x,y\n1,2\n3\n4,5\n")
    kept = split_csv.read_split_csv(spark, str(tmp_path / "w"), ["x", "y"], mode="DROPMALFORMED")
    assert sorted(map(tuple, kept.collect())) == [("1", "2"), ("4", "5")]
    with pytest.raises(Exception):
        split_csv.read_split_csv(spark, str(tmp_path / "w"), ["x", "y"]).collect()


def test_small_ranges_share_tasks(spark, tmp_path):
    rows = [(str(i), "en", "line\n" * 50 + "end") for i in range(2000)]
    path = _write(spark, tmp_path, rows)
    split = split_csv.read_split_csv(spark, path, ["identifier", "lang", "text"], range_bytes=1024)
    assert 8 < split.rdd.getNumPartitions() <= 64
    assert sorted(map(tuple, split.collect())) == sorted((i, lang, text) for i, lang, text in rows)
