import gzip

import pytest
from pyspark.sql import functions as F

from captide.functions.tags import fold_tags, read_tags
from captide.operators import shows


def tags(document, compat=False):
    parsed = read_tags(document.encode() if isinstance(document, str) else document, compat)
    return None if parsed["tags"] is None else dict(parsed["tags"])


def test_leaves_repeats_and_order():
    document = "<m><a>1</a><b>x</b><a>2</a></m>"
    assert tags(document) == {"a": ["1", "2"], "b": ["x"]}


def test_parents_are_left_out_unless_they_are_leaves():
    assert tags("<m><a><b>1</b></a></m>") == {"b": ["1"]}
    assert tags("<m>alone</m>") == {"m": ["alone"]}
    assert tags("<a><a>x</a></a>") == {"a": ["x"]}


def test_attributes_are_ignored_and_empty_elements_kept():
    assert tags('<m><a k="v"/><b></b></m>') == {"a": [""], "b": [""]}


@pytest.mark.parametrize(
    "inner, plain, compat",
    [
        ("x &amp; y", "x & y", "x\n&\ny"),
        ("at&amp;t", "at&t", "at\n&\nt"),
        ("l1\nl2", "l1\nl2", "l1\nl2"),
        ("  l1 \n\n  l2 ", "l1 \n\n  l2", "l1\nl2"),
    ],
)
def test_text_of_an_element(inner, plain, compat):
    document = f"<m><a>{inner}</a></m>"
    assert tags(document) == {"a": [plain]}
    assert tags(document, compat=True) == {"a": [compat]}


def test_long_text_stays_in_one_piece():
    text = "word " * 40_000
    assert tags(f"<m><a>{text}</a></m>") == {"a": [text.strip()]}


def test_truncated_documents_keep_what_was_closed():
    parsed = read_tags(b"<m><a>1</a><b>2")
    assert dict(parsed["tags"]) == {"a": ["1"]}
    assert parsed["truncated"] and parsed["error"] is None
    empty = read_tags(b"")
    assert empty["tags"] == [] and empty["truncated"] and empty["error"] is None
    assert read_tags(b"<m><a>1</a></m>")["truncated"] is False


def test_documents_do_not_leak_into_each_other():
    read_tags(b"<m><a>left over")
    assert tags("<m><a>x</a></m>") == {"a": ["x"]}


@pytest.mark.parametrize("document", [b"<m><a>x</b></m>", b"<m/>junk", b"<m>&nope;</m>", b"\x1f\x8bnot gzip"])
def test_malformed_documents_report_an_error(document):
    parsed = read_tags(document)
    assert parsed["tags"] is None and parsed["error"]


def test_gzip_and_declared_encodings():
    assert tags(gzip.compress(b"<m><a>1</a></m>")) == {"a": ["1"]}
    latin = '<?xml version="1.0" encoding="ISO-8859-1"?><m><a>é</a></m>'.encode("latin-1")
    assert tags(latin) == {"a": ["é"]}


@pytest.fixture
def documents(spark):
    rows = [
        ("s1", b"<metadata><identifier>s1</identifier><collection>A</collection><subject>x</subject>"
               b"<collection>B</collection><identifier-access>u</identifier-access></metadata>"),
        ("s2", b"<metadata><identifier>s2</identifier><collection>C</collection></metadata>"),
        ("bad", b"<metadata><a>x</b></metadata>"),
        ("cut", b"<metadata><identifier>cut</identifier><coll"),
        ("none", None),
    ]
    return spark.createDataFrame(rows, "identifier STRING, content BINARY")


def test_wide_rows_fold_and_quarantine(documents):
    parsed = shows.tag_documents(documents)
    tagged = shows.good_tags(parsed)
    names = shows.tag_names(tagged)
    assert names == ["collection", "identifier", "identifier-access", "subject"]
    wide = {row["identifier"]: row for row in shows.widen(tagged, names).collect() if row["identifier"]}
    assert wide["s1"]["collection"] == "A|B" and wide["s1"]["identifier-access"] == "u"
    assert wide["s2"]["subject"] is None and wide["cut"]["collection"] is None
    quarantine = shows.tag_quarantine(parsed).collect()
    assert sorted((row["identifier"], row["stage"]) for row in quarantine) == [("bad", "meta"), ("none", "meta")]
    folded = tagged.filter("identifier = 's1'").select(fold_tags(F.col("tags")).alias("t")).first()["t"]
    assert folded == {"identifier": "s1", "collection": "A|B", "subject": "x", "identifier-access": "u"}


def test_documents_are_parsed_once(documents, plan_of):
    parsed = shows.tag_documents(documents)
    plan = plan_of(shows.widen(shows.good_tags(parsed), ["a", "b"], "identifier"))
    assert plan.count("ArrowEvalPython") == 1


def test_assembly_keeps_repeats_and_needs_both_documents(spark, documents):
    tagged = shows.good_tags(shows.tag_documents(documents))
    texts = spark.createDataFrame([("s1", "t1"), ("other", "t2")], "identifier STRING, text STRING")
    listed = spark.createDataFrame([("s1",), ("s1",), ("s2",), ("other",), ("bad",)], "identifier STRING")
    rows = shows.assemble_shows(listed, tagged, texts).select("identifier", "text").collect()
    assert [tuple(row) for row in rows] == [("s1", "t1"), ("s1", "t1")]
