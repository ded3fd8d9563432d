import pytest
from pyspark.sql import functions as F

from captide import session
from captide.editions import edition
from captide.operators import release, shows
from captide.operators.skew import heavy_keys
from captide.plans import corpus as plan
from captide.sinks import corpus as sink
from captide.sinks.documents import write_documents
from captide.sources.corpus import read_corpus

TEXTS = ['plain', 'two\nlines', '"quoted", with comma', "  spaces  ", "back\\slash\\", "é€😀", "b'x'", "tab\t", "NA", ""]


def test_corpus_round_trip(spark, tmp_path):
    path = str(tmp_path / "corpus")
    rows = [(str(n), text) for n, text in enumerate(TEXTS)] + [("null", None)]
    sink.write_corpus(spark.createDataFrame(rows, "identifier STRING, text STRING").coalesce(1), path, max_rows=4)
    files = list((tmp_path / "corpus").glob("*.csv.gz"))
    assert len(files) == 3
    read = {r["identifier"]: r["text"] for r in read_corpus(spark, path).collect()}
    # Empty and absent are the same in CSV.
    assert read == {**dict(rows), str(TEXTS.index("")): None}


def test_appends_go_by_name(spark, tmp_path):
    path = str(tmp_path / "shows")
    one = spark.createDataFrame([("a", "t1", "x")], "identifier STRING, text STRING, zone STRING")
    two = spark.createDataFrame([("b", "t2", "th")], "identifier STRING, text STRING, thumbs STRING")
    columns = sink.append_shows(one, path)
    assert columns == ["identifier", "zone", "text"]
    with pytest.raises(ValueError, match="thumbs"):
        sink.append_shows(two, path, schema_mode="fail")
    columns = sink.append_shows(two, path)
    assert columns == ["identifier", "thumbs", "zone", "text"]
    expected = [("a", None, "x", "t1"), ("b", "th", None, "t2")]
    assert sorted(tuple(r) for r in sink.read_shows(spark, path, columns).collect()) == expected
    merged = sink.read_shows(spark, path)
    assert merged.columns == columns
    assert sorted(tuple(r) for r in merged.collect()) == expected


def test_release_files_are_bounded_and_listed(spark, tmp_path):
    path = str(tmp_path / "release")
    rows = spark.range(1000).select(
        F.when(F.col("id") < 900, "2022").otherwise("2023").alias("edition"), F.col("id").cast("string").alias("identifier")
    )
    sink.write_release(rows, path, max_rows=150)
    manifest = sink.release_manifest(spark.read.parquet(path)).collect()
    assert sum(r["rows"] for r in manifest) == 1000 and max(r["rows"] for r in manifest) <= 150
    assert all(r["bytes"] > 0 for r in manifest)
    assert [r["file"] for r in manifest] == sorted(r["file"] for r in manifest)
    csv = str(tmp_path / "csv")
    sink.write_release(rows.repartition(20), csv, max_rows=500, file_format="csv", gather=True)
    assert len(list((tmp_path / "csv").glob("*/*.csv.gz"))) < 20
    assert spark.read.option("header", True).csv(csv).count() == 1000


def test_bucketed_tables_join_without_a_shuffle(spark, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        corpus = spark.range(200).select(F.col("id").cast("string").alias("identifier"), F.lit("t").alias("text"))
        cleaned = spark.range(100).select(F.col("id").cast("string").alias("identifier"), F.lit("c").alias("text_nc"))
        sink.write_bucketed(corpus, "corpus_bucketed", "identifier", 4)
        sink.write_bucketed(cleaned, "cleaned_bucketed", "identifier", 4)
        merged = release.merge_cleaned(
            spark.table("corpus_bucketed"), spark.table("cleaned_bucketed").withColumnRenamed("identifier", "archive_id")
        )
        plan = plan_of(merged)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert merged.filter("text_nc IS NOT NULL").count() == 100 and merged.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_keeps_rows_repeats_and_nulls(spark):
    corpus = spark.createDataFrame([("a", "b'x'"), ("b", "y"), ("c", "z"), (None, "n")], "identifier STRING, text STRING")
    cleaned = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", ""), ("other", "o")], "archive_id STRING, text_nc STRING")
    merged = release.merge_cleaned(corpus, cleaned, edition("2023").repr_pattern)
    assert merged.columns == ["identifier", "text", "text_nc"]
    rows = sorted((tuple(r) for r in merged.collect()), key=repr)
    assert rows == sorted(
        [("a", "x", "1"), ("a", "x", "2"), ("b", "y", ""), ("c", "z", None), (None, "n", None)], key=repr
    )
    assert release.cleaned_rows(merged, "text", "text_nc").count() == 3


def caption(*spans):
    return "".join(
        f'<div class="tvcol"><a href="/start/{a}/end/{b}"></a><div class="snipin nosel">{a}-{b};</div></div>' for a, b in spans
    ).encode()


def test_from_files_to_release(spark, tmp_path):
    meta_folder, page_folder = str(tmp_path / "meta"), str(tmp_path / "html")
    meta = [
        ("s1", b"<metadata><identifier>s1</identifier><collection>A</collection><collection>B</collection></metadata>"),
        ("s2", b"<metadata><identifier>s2</identifier><title>two</title></metadata>"),
        ("bad", b"<metadata><a></b></metadata>"),
        ("pageless", b"<metadata><identifier>pageless</identifier></metadata>"),
        ("unlisted", b"<metadata><secret>1</secret></metadata>"),
    ]
    pages = [("s1", caption((0, 5), (12, 13))), ("s2", caption((0, 1))), ("bad", b""), ("unlisted", b"")]
    schema = "identifier STRING, content BINARY"
    write_documents(spark.createDataFrame(meta, schema), meta_folder, F.concat("identifier", F.lit("_meta.xml")))
    write_documents(spark.createDataFrame(pages, schema), page_folder, F.concat("identifier", F.lit(".html.gz")), True)

    stored_meta = plan.compact_documents(spark, meta_folder, "meta", str(tmp_path / "bronze_meta"))
    stored_pages = plan.compact_documents(spark, page_folder, "page", str(tmp_path / "bronze_pages"))
    listed = spark.createDataFrame([("s2",), ("s1",), ("s2",), ("bad",), ("pageless",), ("unknown",)], "identifier STRING")
    wide, quarantine = plan.parse_shows(listed, stored_meta, stored_pages, str(tmp_path / "work"))
    assert wide.columns == ["collection", "identifier", "title", "text"]
    assert sorted((tuple(r) for r in wide.collect()), key=repr) == [
        ("A|B", "s1", None, "0-5;12-13;"),
        (None, "s2", "two", "0-1;"),
        (None, "s2", "two", "0-1;"),
    ]
    assert [(r["identifier"], r["stage"]) for r in quarantine.collect()] == [("bad", "meta")]

    records = spark.createDataFrame([("s1", [[10000.0, 20000.0]], 0)], "archive_id STRING, intervals ARRAY<ARRAY<DOUBLE>>, pos INT")
    archived = stored_pages.withColumnRenamed("identifier", "archive_id")
    examined = plan.cut_edition(archived, records, edition("2022"), str(tmp_path / "cut"))
    assert plan.cut_quarantine(examined).count() == 0
    released = plan.release_edition(wide, plan.cleaned_texts(examined), edition("2022"))
    sink.write_release(released, str(tmp_path / "release"), max_rows=10)
    back = spark.read.parquet(str(tmp_path / "release"))
    assert sorted((r["identifier"], r["text_nc"]) for r in back.collect() if r["text_nc"]) == [("s1", "0-5;")]
    assert back.count() == 3


@pytest.mark.parametrize("small", [True, False])
def test_unlisted_documents_leave_no_trace(spark, tmp_path, monkeypatch, small):
    """The wide table and the quarantine are the same on both sides of the broadcast bound."""
    monkeypatch.setattr(shows, "broadcast_if_small", lambda df: (df, small))
    listed = spark.createDataFrame([("s1",), ("s2",)], "identifier STRING")
    documents = [("s1", "<m><a>1</a></m>"), ("s2", "<m><b>2</b"), ("u1", "<m><own>3</own></m>"), ("u2", "broken"), ("s3", None)]
    meta = spark.createDataFrame([(i, x and x.encode()) for i, x in documents], "identifier STRING, content BINARY")
    pages = spark.createDataFrame([("s1", b"<div class='snipin nosel'>t</div>"), ("u1", b"x"), ("s2", None), ("u2", None)], "identifier STRING, content BINARY")
    wide, quarantine = plan.parse_shows(listed, meta, pages, str(tmp_path))
    assert "own" not in wide.columns and [r.asDict()["text"] for r in wide.filter("identifier = 's1'").collect() or wide.collect()][:1] == ["t"]
    faults = sorted((r["identifier"], r["stage"]) for r in quarantine.collect())
    assert ("s2", "page") in faults and all(name in ("s1", "s2") for name, _ in faults)


def test_a_heavy_key_is_bucketed_whole(spark, monkeypatch):
    rows = spark.range(100).select(F.when(F.col("id") < 90, "same").otherwise(F.col("id").cast("string")).alias("identifier"), "id")
    monkeypatch.setattr(sink, "heavy_keys", lambda df, key: heavy_keys(df, key, 50))
    monkeypatch.setattr(sink, "HEAVY_ROWS", 20)
    sink.write_bucketed(rows, "heavy_bucketed", "identifier", 4)
    try:
        assert sorted(r["id"] for r in spark.table("heavy_bucketed").collect()) == list(range(100))
    finally:
        spark.sql("DROP TABLE heavy_bucketed")


def test_only_small_inputs_in_few_files_are_spread(spark, tmp_path, monkeypatch):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "few"))
    spark.range(100).repartition(40).write.parquet(str(tmp_path / "many"))
    few, many = spark.read.parquet(str(tmp_path / "few")), spark.read.parquet(str(tmp_path / "many"))
    assert session.spread(few).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert session.spread(many) is many
    monkeypatch.setattr(session, "SPREAD_BYTES_PER_CORE", 1)
    assert session.spread(few) is few


def test_broadcasts_are_measured(spark, plan_of):
    df = spark.createDataFrame([("a" * 1000,)], "k STRING")
    assert session.broadcast_if_small(df)[1] and not session.broadcast_if_small(df, max_bytes=500)[1]
    assert session.payload_bytes(df.limit(0)) == 0


def test_scratch_folders_are_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert one != two and one.startswith(base)


def test_shards_bounded_by_bytes(spark):
    import json as _json

    import pytest as _pytest

    from captide.sinks import corpus as sinks

    rows = [(["en", "fr", None][i % 3], f"id{i:04d}", "x" * (i % 97)) for i in range(600)]
    df = spark.createDataFrame(rows, "edition string, identifier string, text string").repartition(5)
    bound = 2000
    got = sinks.shard_by_bytes(df, bound, "identifier").collect()
    order = lambda r: (str(r[0]), r[1])
    assert sorted(((r["edition"], r["identifier"], r["text"]) for r in got), key=order) == sorted(rows, key=order)
    by_shard = {}
    for r in got:
        size = len(_json.dumps({k: v for k, v in (("edition", r["edition"]), ("identifier", r["identifier"]), ("text", r["text"])) if v is not None}, separators=(",", ":")))
        assert size == r["row_bytes"]
        by_shard.setdefault((r["edition"], r["shard"]), []).append(r)
    assert len(by_shard) > 10
    assert all(sum(r["row_bytes"] for r in group) <= bound for group in by_shard.values())
    for edition in ("en", "fr", None):
        shards = sorted(k[1] for k in by_shard if k[0] == edition)
        spans = [(min(r["identifier"] for r in by_shard[(edition, s)]), max(r["identifier"] for r in by_shard[(edition, s)])) for s in shards]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    with _pytest.raises(ValueError):
        sinks.shard_by_bytes(df, 50, "identifier")


@pytest.mark.parametrize("largest", [2000, 9000])
def test_shards_of_rows_about_as_large_as_the_bound(spark, tmp_path, largest):
    bound = 2000
    fill = lambda size, i: "x" * (size - len(f'{{"edition":"en","identifier":"id{i:04d}","text":""}}'))
    sizes = [largest if i in (0, 7, 8, 79) else 60 + i * 37 % 1400 for i in range(80)]
    rows = [("en", f"id{i:04d}", fill(size, i)) for i, size in enumerate(sizes)]
    df = spark.createDataFrame(rows, "edition string, identifier string, text string").repartition(5)
    path = str(tmp_path / "release")
    sink.write_release_by_bytes(df, path, bound, "identifier", oversized="alone")
    shards = {}
    for r in spark.read.parquet(path).collect():
        shards.setdefault(r.shard, []).append((r.identifier, sizes[int(r.identifier[2:])]))
    assert sorted(i for rows in shards.values() for i, _ in rows) == [f"id{i:04d}" for i in range(80)]
    assert all(len(rows) == 1 or sum(size for _, size in rows) <= bound for rows in shards.values())
    spans = [(min(shards[s]), max(shards[s])) for s in sorted(shards)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert len(shards) < 80
    if largest > bound:
        with pytest.raises(ValueError):
            sink.shard_by_bytes(df, bound, "identifier")
