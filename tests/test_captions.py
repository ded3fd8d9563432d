import gzip
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from captide.editions import EDITIONS, edition
from captide.functions import captions
from captide.functions.captions import read_containers, read_snippets
from captide.functions.documents import declared_charset
from captide.operators import shows


def snippets(page):
    return read_snippets(page.encode() if isinstance(page, str) else page)["snippets"]


def containers(page):
    parsed = read_containers(page.encode())
    if parsed["error"]:
        return parsed["error"]
    return [(c["href"], c["text"]) for c in parsed["containers"]]


def snip(text, classes="snipin nosel"):
    return f'<div class="{classes}">{text}</div>'


def col(inner, classes="tvcol"):
    return f'<div class="{classes}">{inner}</div>'


def test_snippet_class_must_match_as_a_whole():
    page = snip("a") + snip("b", "snipin nosel x") + snip("c", "nosel snipin") + snip("d", " snipin  nosel ")
    assert snippets(page) == ["a", "d"]


def test_container_class_is_one_of_several():
    page = col('<a href="/start/1/end/2"></a>' + snip("x"), "tvcol hidden")
    assert containers(page) == [("/start/1/end/2", "x")]
    assert containers(col("<a href='q'></a>", "tvcolumn")) == []


def test_nested_snippets_repeat_the_inner_text():
    assert snippets(snip("a " + snip("b") + " c")) == ["a b c", "b"]


def test_nested_containers_share_the_first_link_and_text():
    page = col(col('<a href="in"></a>' + snip("x")) + '<a href="out"></a>' + snip("y"))
    assert containers(page) == [("in", "x"), ("in", "x")]


def test_unclosed_tags_end_with_their_container():
    page = col('<a href="1"></a>' + snip("x <b>y")) + col('<a href="2"></a>' + snip("z"))
    assert containers(page) == [("1", "x y"), ("2", "z")]


def test_closing_tags_without_opening_are_ignored():
    assert snippets(snip("a </b></p> b")) == ["a b"]


def test_text_nodes_are_stripped_and_joined():
    assert snippets(snip("don<i>'</i>t")) == ["don ' t"]
    assert snippets(snip("\xa0 a\n b \xa0")) == ["a\n b"]
    assert snippets(snip("a<br>b<!-- c -->d")) == ["a b d"]


def test_silent_elements_give_no_text():
    assert snippets(snip("a<script>var x='<div>'</script><style>b{}</style>c")) == ["a c"]


def test_entities():
    assert snippets(snip("&gt;&gt; it&#39;s &#x41;&amp;&nope; &copy 5 &#150; &#99999999;")) == [
        ">> it's A&&nope © 5 – �"
    ]


def test_pages_without_captions_have_no_snippets():
    assert snippets("<html><body><h1>404</h1></body></html>") == []
    assert snippets(b"") == []


def test_faulty_containers_spoil_the_page():
    assert containers(col(snip("x"))) == "container without link"
    assert containers(col("<a>x</a>" + snip("x"))) == "link without href"
    assert containers(col("<a href>x</a>" + snip("x"))) == [("", "x")]
    assert containers(col('<a href="1"></a>')) == [("1", None)]


def test_a_link_after_the_container_is_not_its_link():
    assert containers(col(snip("x")) + '<a href="1"></a>') == "container without link"


def test_bytes_are_inflated_and_decoded():
    assert snippets(gzip.compress(snip("é").encode())) == ["é"]
    assert snippets(snip("é").encode("windows-1252")) == ["é"]
    assert snippets(b'<meta charset="iso-8859-2">' + snip("ł").encode("iso-8859-2")) == ["ł"]
    assert snippets(b"\xef\xbb\xbf" + snip("é").encode()) == ["é"]
    assert snippets(b'<meta charset="no-such">' + snip("é").encode()) == ["é"]


class _LibraryOnly(captions._CaptionReader):
    goahead = HTMLParser.goahead


PIECES = (
    ['<div class="tvcol">', "<div class=tvcol>", '<div class="snipin nosel">', "<div class='snipin nosel'>", "</div>", "</DIV >"]
    + ['<a href="/start/1/end/2">', '<a href="?a=1&amp;b=2">', "<a href>", "<a>", "</a>", "<b>", "</b>", "<br>", "<br/>"]
    + ['<img src="x>y"/>', "text ", "it&#39;s", "&amp;", "&foo;", "&copy", "&", " < ", "<", ">", "<!-- c -->", "<!--", "-->"]
    + ["<script>", "</script>", "<style>a<b</style>", "<title>", "</title>", "<textarea>", "<![CDATA[x]]>", "<?pi?>"]
    + ["<!DOCTYPE html>", "<div/>", '<a href="x" href="y">', '<p class="a"b>', "<a b=c>", '<div\tclass="tvcol"\n>']
    + ['<div class="tvcol" / >', '<DIV CLASS="tvcol">', "<a hreF='/start/7/end/8'>", "\xa0", "<i", '"', "'", '<div class="tv', 'col">']
)


def test_plain_markup_agrees_with_the_library():
    choose = random.Random(5)

    def outcome(reader, page):
        try:
            read = reader().read(page)
            return read.snippets, read.containers
        except Exception as problem:
            return repr(problem)

    for _ in range(3000):
        page = "".join(choose.choices(PIECES, k=choose.randint(1, 25))).encode()
        assert outcome(captions._CaptionReader, page) == outcome(_LibraryOnly, page), page


@pytest.mark.parametrize(
    "name, href, expected",
    [
        ("2022", "/start/3/end/4/x", (3000, 4000)),
        ("2022", "x/start/1/end/2", (None, None)),
        ("2017", "/start/3/end/", (None, None)),
        ("2014", "q#start/1/end/2#start/5/end/6", (5000, 6000)),
        ("2014", "q\r#start/5/end/6", (5000, 6000)),
        ("2014", "/start/1/end/2", (None, None)),
    ],
)
def test_link_times(spark, name, href, expected):
    start, end = captions.link_times(F.col("href"), EDITIONS[name])
    assert tuple(spark.createDataFrame([(href,)], "href STRING").select(start, end).first()) == expected


def test_segments_keep_only_timed_containers(spark):
    page = col('<a href="/start/1/end/2"></a>' + snip("a")) + col('<a href="/other"></a>' + snip("b"))
    df = spark.createDataFrame([(page.encode(),)], "content BINARY")
    parsed = df.select(captions.parse_containers(F.col("content")).alias("p"))
    segments = parsed.select(captions.timed_segments(F.col("p.containers"), edition("2022")).alias("s")).first()["s"]
    assert [tuple(s) for s in segments] == [(0, 1000, 2000, "a")]


def test_text_may_exceed_the_segments(spark):
    page = col('<a href="/start/1/end/2"></a>' + snip("a") + snip("b")) + snip("c")
    df = spark.createDataFrame([("s", page.encode()), ("e", b"<p>404"), ("n", None)], "identifier STRING, content BINARY")
    texts = {row["identifier"]: row["text"] for row in shows.caption_texts(df).collect()}
    assert texts == {"s": "abc", "e": "", "n": None}
    assert containers(page) == [("/start/1/end/2", "a")]


@pytest.mark.parametrize(
    "page, charset",
    [
        (b"<script charset='iso-8859-1'></script><meta charset='utf-8'>", "utf-8"),
        (b"<link charset='iso-8859-1'><p>no declaration</p>", None),
        (b"<head>" + b"<!-- filler -->" * 20_000 + b"<meta http-equiv=x content='text/html; charset=Latin-1'>", "Latin-1"),
        (b"\n<?xml version='1.0' encoding='koi8-r'?><html>", "koi8-r"),
        (b"<!-- <meta charset='koi8-r'> --><script>'<meta charset=koi8-r>'</script>", None),
        (b"<head></head><body><meta charset='koi8-r'>", None),
    ],
)
def test_only_declarations_name_a_charset(page, charset):
    assert declared_charset(page) == charset
