import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from captide.editions import edition
from captide.operators import catalogue, commercials, ordering
from captide.sinks.documents import write_documents
from captide.sources import archives, corpus, identifiers
from captide.sources.commercials import read_commercials
from captide.sources.documents import read_documents, scan_documents
from captide.sources.files import locate
from captide.sources.identifiers import read_archive_listing, read_identifiers, skip_identifiers


def test_identifier_positions_follow_files_and_lines(spark, tmp_path):
    for n in range(4):
        lines = "".join(f'"id-{n}-{i}"\n' for i in range(50 * (4 - n)))
        (tmp_path / f"part-{n}.csv").write_text('"identifier"\n' + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        listed = read_identifiers(spark, str(tmp_path))
        rows = sorted((r["pos"], r["identifier"]) for r in listed.collect())
        assert listed.select("identifier").rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [f"id-{n}-{i}" for n in range(4) for i in range(50 * (4 - n))]
    assert rows == list(enumerate(expected))
    skipped = sorted(r["identifier"] for r in skip_identifiers(listed, 120).collect())
    assert skipped == sorted(expected[120:])


def test_part_files_are_ordered_by_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(identifiers, "MAX_BROADCAST_BLOCKS", 0)
    for n in (99999, 100000, 7):
        (tmp_path / f"part-{n:05d}-x.csv").write_text(f"identifier\nid{n}\n")
    rows = sorted((r["pos"], r["identifier"]) for r in read_identifiers(spark, str(tmp_path)).collect())
    assert rows == [(0, "id7"), (1, "id99999"), (2, "id100000")]


def test_identifier_column_by_name_or_first(spark, tmp_path):
    (tmp_path / "list.csv").write_text('n,identifier\n1,"a"\n2,"b"\n')
    by_name = read_identifiers(spark, str(tmp_path / "list.csv"))
    assert sorted(r["identifier"] for r in by_name.collect()) == ["a", "b"]
    first = read_identifiers(spark, str(tmp_path / "list.csv"), column=None)
    assert sorted(r["identifier"] for r in first.collect()) == ["1", "2"]


def test_plain_documents_win(spark, tmp_path, plan_of):
    (tmp_path / "a_meta.xml").write_bytes(b"plain a")
    (tmp_path / "a_meta.xml.gz").write_bytes(gzip.compress(b"gz a"))
    (tmp_path / "b c+d%_meta.xml.gz").write_bytes(gzip.compress(b"gz b"))
    (tmp_path / "c_meta.xml").write_bytes(b"plain c")
    (tmp_path / "c.html").write_bytes(b"page c")
    (tmp_path / "other.txt").write_bytes(b"x")
    documents = read_documents(spark, str(tmp_path), "meta")
    found = {r["identifier"]: bytes(r["content"]) for r in documents.collect()}
    assert set(found) == {"a", "b c+d%", "c"}
    assert found["a"] == b"plain a" and gzip.decompress(found["b c+d%"]) == b"gz b"
    assert [r["identifier"] for r in read_documents(spark, str(tmp_path), "page").collect()] == ["c"]
    # Names alone do not read contents.
    names = plan_of(scan_documents(spark, str(tmp_path), "meta").select("identifier"))
    assert "ReadSchema: struct<path:string>" in names or "content" not in names


def test_written_documents_are_found_again(spark, tmp_path):
    folder = str(tmp_path / "new" / "folder")
    rows = spark.createDataFrame([("a", b"1"), ("b", b"2")], "identifier STRING, content BINARY")
    name = F.concat("identifier", F.lit(".html.gz"))
    assert write_documents(rows, folder, name, compressed=True) == 2
    found = read_documents(spark, folder, "page").collect()
    assert sorted((r["identifier"], gzip.decompress(r["content"])) for r in found) == [("a", b"1"), ("b", b"2")]


RECORDS = [
    {"archive_id": "a", "intervals": [[1, 2.5]], "extra": 1},
    {"archive_id": "b", "intervals": []},
    {"archive_id": "a", "intervals": [[7, 8]]},
]


@pytest.mark.parametrize("lines", [True, False])
def test_commercial_records(spark, tmp_path, lines):
    path = tmp_path / "commercial.json"
    path.write_text("\n".join(map(json.dumps, RECORDS)) if lines else json.dumps(RECORDS, indent=1))
    records = read_commercials(spark, str(path), lines)
    first = {r["archive_id"]: r["intervals"] for r in commercials.first_records(records).collect()}
    assert first == {"a": [[1.0, 2.5]], "b": []}


LISTING = """drwxr-xr-x tv/tv 0 2022-01-01 00:00 html/
-rw-r--r-- tv/tv 9 2022-01-01 00:00 html/A.html{gz}
-rw-r--r-- tv/tv 9 2022-01-01 00:00 html/B.html{gz} \r
-rw-r--r-- tv/tv 9 2022-01-01 00:00 html/C.txt
"""


@pytest.mark.parametrize(
    "name, expected", [("2017", ["", "A", "B", "C.txt"]), ("2022", ["A", "B"]), ("2023", ["", "A", "B", "C.txt"])]
)
def test_archive_listings(spark, tmp_path, name, expected):
    settings = edition(name)
    (tmp_path / "list.txt").write_bytes(LISTING.format(gz=".gz" if settings.member_suffix.endswith(".gz") else "").encode())
    listed = read_archive_listing(spark, str(tmp_path / "list.txt"), settings)
    assert sorted(r["archive_id"] for r in listed.collect()) == expected


def archive(path, mode, members):
    with tarfile.open(path, mode) as tar:
        folder = tarfile.TarInfo("html")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for name, content in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(content)
            tar.addfile(entry, io.BytesIO(content))


@pytest.mark.parametrize("mode, suffix, read", [("w:gz", ".tar.gz", "read_members"), ("w", ".tar", "read_plain_members")])
def test_archive_members(spark, tmp_path, mode, suffix, read):
    members = [(f"html/s{n}.html", f"page {n}".encode() * (n + 1)) for n in range(20)]
    archive(tmp_path / f"one{suffix}", mode, members[:15] + [("html/readme.txt", b"x")])
    archive(tmp_path / f"two{suffix}", mode, members[15:])
    listed = archives.list_archives(spark, str(tmp_path))
    wanted = spark.createDataFrame([("s1",), ("s17",), ("absent",)], "archive_id STRING")
    reader = getattr(archives, read)
    everything = {r["archive_id"]: bytes(r["content"]) for r in reader(listed, edition("2022")).collect()}
    assert everything == {name[5:-5]: content for name, content in members}
    some = {r["archive_id"] for r in reader(listed, edition("2022"), wanted).collect()}
    assert some == {"s1", "s17"}


def test_large_members_come_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(archives, "_BATCH_BYTES", 100)
    rows = ({"name": str(n), "content": b"x" * 30} for n in range(10))
    batches = list(archives._in_batches(rows, archives._MEMBERS, lambda row: len(row["content"])))
    assert [b.num_rows for b in batches] == [4, 4, 2]


def test_corpus_csv(spark, tmp_path):
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(b'a,text\n1,"two\nlines, ""quoted"""\n2,\n3,""\nNA,x\n'))
    read = corpus.read_corpus(spark, str(tmp_path / "c.csv.gz"))
    assert read.columns == ["a", "text"]
    assert [tuple(r) for r in read.collect()] == [("1", 'two\nlines, "quoted"'), ("2", None), ("3", None), ("NA", "x")]


def test_preview(spark, plan_of):
    df = spark.range(100).select(F.col("id"), (F.col("id") * 2).alias("b"), F.lit("x").alias("c"))
    shown = ordering.preview(df, 3, ["b"], "id")
    assert [tuple(r) for r in shown.collect()] == [(0,), (2,), (4,)]


def test_row_at_a_position(spark, monkeypatch):
    df = spark.range(10).select((9 - F.col("id")).alias("id"), F.lit("x").alias("c"))
    for top in (ordering.TOP_ROWS, 0):
        monkeypatch.setattr(ordering, "TOP_ROWS", top)
        assert [r["id"] for r in ordering.row_at(df, 3, ["id"], "id").collect()] == [3]
        assert ordering.row_at(df, 10, ["id"], "id").collect() == []


@pytest.mark.parametrize("n", [0, 1, 499, 500, 900, 1000, 5000])
def test_many_first_rows(spark, n):
    df = spark.range(1000).select(F.concat(F.lit("id"), (F.col("id") * 7 % 1000).cast("string")).alias("k")).repartition(5)
    expected = sorted(f"id{i}" for i in range(1000))[:n]
    large = ordering.first_in_order(df, "k", n, top_rows=-1)
    assert sorted(r["k"] for r in large.collect()) == expected
    assert [r["k"] for r in ordering.first_in_order(df, "k", n).collect()] == expected


def test_catalogue_search(spark):
    rows = [("b", ["tvarchive", "x"], "2020-01-02"), ("a", ["tvarchive"], "2020-01-01"), ("c", ["x"], "2021-01-01"), ("d", None, None)]
    shows = spark.createDataFrame(rows, "identifier STRING, collection ARRAY<STRING>, date STRING")
    assert sorted(r[0] for r in catalogue.search_catalogue(shows).collect()) == ["a", "b"]
    assert [r[0] for r in catalogue.search_catalogue(shows, "2020-01-02").collect()] == ["b"]
    assert [r[0] for r in catalogue.search_catalogue(shows, "2020-1-2").collect()] == ["b"]
    assert [r[0] for r in catalogue.search_catalogue(shows, limit=1).collect()] == ["a"]
    for date in ("2020-13-01", "2020-01", "soon", "0-1-1"):
        with pytest.raises(ValueError, match="Invalid date"):
            catalogue.search_catalogue(shows, date)


def test_pending_work_and_report(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "identifier STRING")

    stored = {"meta": ids("a", "b"), "page": ids("b")}
    work = catalogue.pending_work(ids("a", "b", "c", "c"), stored)
    assert sorted(tuple(r) for r in work.collect()) == [("a", "page"), ("c", "meta"), ("c", "meta"), ("c", "page"), ("c", "page")]
    tagged = spark.createDataFrame([("a", {"x": ["1"], "y": []}), ("b", {"y": ["2"]})], "identifier STRING, tags MAP<STRING, ARRAY<STRING>>")
    report = {r["measure"]: r["n"] for r in catalogue.ingest_report(ids("a", "b", "c", "c"), stored, tagged).collect()}
    assert report == {"listed": 4, "stored_meta": 2, "stored_page": 1, "tags": 2}


def test_faulty_records_end_the_read(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([{"archive_id": "a", "intervals": [[1, 2]]}] * 2, indent=1))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_commercials(spark, str(tmp_path / "array.json")).collect()
    assert read_commercials(spark, str(tmp_path / "array.json"), lines=False).count() == 2
    (tmp_path / "c.csv").write_text('"a","b"\n"1","2","3"\n"4","5"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        corpus.read_corpus(spark, str(tmp_path / "c.csv")).collect()
    kept = corpus.read_corpus(spark, str(tmp_path / "c.csv"), mode="DROPMALFORMED").collect()
    assert [tuple(r) for r in kept] == [("4", "5")]


def test_unknown_schemes_are_refused():
    for uri in ("dbfs:/mnt/x", "wasb://c@a/x"):
        with pytest.raises(ValueError, match="no file system"):
            locate(uri)
    assert locate("file:/tmp/x")[1] == locate("/tmp/x")[1] == locate("file:///tmp/x")[1] == "/tmp/x"
