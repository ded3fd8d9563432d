import gzip

from captide.operators.shows import caption_texts, tag_documents
from captide.streaming import ingest as stream

SCHEMA = "identifier STRING, content BINARY"


def pages(spark, *rows):
    wrapped = [(name, f'<div class="snipin nosel">{text}</div>'.encode()) for name, text in rows]
    return spark.createDataFrame(wrapped, SCHEMA).coalesce(1)


def texts(spark, target):
    return sorted((r["identifier"], r["text"]) for r in spark.read.parquet(target).collect())


def test_stream_equals_batch_and_first_arrival_stays(spark, tmp_path):
    raw, target, checkpoint = (str(tmp_path / name) for name in ("raw", "target", "checkpoint"))
    first = pages(spark, ("a", "1"), ("b", "2"), ("a", "again"))
    first.write.parquet(raw)
    stream.ingest(stream.raw_stream(spark, raw), "page", target, checkpoint)
    assert texts(spark, target) == [("a", "1"), ("b", "2")]

    pages(spark, ("b", "late"), ("c", "3")).write.mode("append").parquet(raw)
    stream.ingest(stream.raw_stream(spark, raw, max_files=1), "page", target, checkpoint)
    stream.ingest(stream.raw_stream(spark, raw), "page", target, checkpoint)
    batch = caption_texts(pages(spark, ("a", "1"), ("b", "2"), ("c", "3")))
    assert texts(spark, target) == sorted((r["identifier"], r["text"]) for r in batch.collect())


def test_repeated_batches_add_nothing(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "target")
    pages(spark, ("a", "1"), ("b", "2")).write.parquet(raw)
    # A lost checkpoint makes the stream deliver everything again.
    for attempt in ("one", "two"):
        stream.ingest(stream.raw_stream(spark, raw), "page", target, str(tmp_path / attempt))
    assert texts(spark, target) == [("a", "1"), ("b", "2")]


def test_file_stream_prefers_plain_documents(spark, tmp_path):
    folder, target = tmp_path / "meta", str(tmp_path / "target")
    folder.mkdir()
    (folder / "a_meta.xml").write_bytes(b"<m><form>plain</form></m>")
    (folder / "a_meta.xml.gz").write_bytes(gzip.compress(b"<m><form>gz</form></m>"))
    (folder / "b_meta.xml.gz").write_bytes(gzip.compress(b"<m><form>gz</form></m>"))
    (folder / "a.html").write_bytes(b"not metadata")
    stream.ingest(stream.file_stream(spark, str(folder), "meta"), "meta", target, str(tmp_path / "checkpoint"))
    (folder / "b_meta.xml").write_bytes(b"<m><form>plain</form></m>")
    (folder / "c_meta.xml").write_bytes(b"<m><form>plain</form></m>")
    stream.ingest(stream.file_stream(spark, str(folder), "meta", 1), "meta", target, str(tmp_path / "checkpoint"))
    forms = {r["identifier"]: r["tags"]["form"] for r in spark.read.parquet(target).collect()}
    assert forms == {"a": ["plain"], "b": ["gz"], "c": ["plain"]}


def test_metadata_stream_keeps_errors(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "target")
    rows = [("good", b"<m><a>1</a></m>"), ("bad", b"<m></x>")]
    documents = spark.createDataFrame(rows, SCHEMA)
    documents.write.parquet(raw)
    stream.ingest(stream.raw_stream(spark, raw), "meta", target, str(tmp_path / "checkpoint"))
    streamed = {r["identifier"]: (r["tags"], r["error"]) for r in spark.read.parquet(target).collect()}
    batch = {r["identifier"]: (r["tags"], r["error"]) for r in tag_documents(documents).collect()}
    assert streamed == batch and streamed["bad"][0] is None


def test_new_documents_choose_by_origin(spark):
    rows = [("a", b"2", ("f2", 0)), ("a", b"1", ("f1", 5)), ("b", b"x", ("f1", 1)), ("c", b"y", ("f1", 2))]
    batch = spark.createDataFrame(rows, "identifier STRING, content BINARY, origin STRUCT<file STRING, row BIGINT>")
    known = spark.createDataFrame([("b",), ("z",)], "identifier STRING")
    new = stream.new_documents(batch, known)
    assert sorted((r["identifier"], bytes(r["content"])) for r in new.collect()) == [("a", b"1"), ("c", b"y")]


def test_sql_functions(spark):
    from captide.functions.register import register_functions

    register_functions(spark)
    page = '<div class="tvcol"><a href="/start/1/end/2"></a><div class="snipin nosel">x</div></div>' * 2
    spark.createDataFrame([("s", page.encode(), b"<m><a>1</a></m>")], "id STRING, page BINARY, meta BINARY").createOrReplaceTempView("raw")
    rows = spark.sql("SELECT id, r.* FROM raw, LATERAL tv_segment_rows(page) r").collect()
    assert [tuple(r) for r in rows] == [("s", 0, "/start/1/end/2", "x"), ("s", 1, "/start/1/end/2", "x")]
    row = spark.sql("SELECT tv_tag_map(meta).tags AS t, size(tv_segments(page).containers) AS n, tv_snippets(page).snippets AS s FROM raw").first()
    assert (row["t"], row["n"], row["s"]) == ({"a": ["1"]}, 2, ["x", "x"])


def test_identifiers_are_decided_without_content(spark, tmp_path, plan_of):
    pages(spark, ("a", "1"), ("b", "2")).write.parquet(str(tmp_path / "raw"))
    batch = stream.raw_stream(spark, str(tmp_path / "raw"))
    plan = []
    query = batch.writeStream.foreachBatch(lambda df, _: plan.append(plan_of(stream.chosen_documents(stream.staged(df, "arrived"), None))))
    query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert "ReadSchema: struct<identifier" in plan[0] and "content" not in plan[0]
