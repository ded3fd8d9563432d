"""Main text of hand-made pages, and of the pages of the test tables against the documents they were made of."""

from pathlib import Path

import pytest

from captide.llm import html_extract, queries
from captide.llm.html_extract import main_text

SF_DIR = "/root/testdata/sf0.01"

CASES = [
    ("", ""),
    ("plain &amp; simple &#x263A; a &lt; b < c", "plain & simple ☺ a < b < c"),
    ("<nav>Menu<article><h1>T</h1><p>a  <b>b\n</b>c<p>d<br>e</article><footer>f</footer>", "T\na b c\nd e"),
    ("<article><header><h1>Head</h1></header><p>x</p><aside>side</aside><div class='ad-box'>buy</div><footer>by</footer></article>", "Head\nx"),
    ("<header>Site</header><main><article><p>x</p></article></main><div id='comments'><article class='comment'><p>no</p></article></div>", "x"),
    ("<article><p>x</p><section class=\"reader-comments\"><h2>Comments</h2><p>no</p></section><p>y</p></article>", "x\ny"),
    ("<body><div class=cookieNotice>c</div><div role=navigation>n</div><p>text</p><form>f<input value='>'>g</form><p hidden>h</p></body>", "text"),
    ("<script>var t=\"</p><article>\";</script><style>p{}</style><title>t</title><p>x<!-- <p>no --><p>y", "x\ny"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table><pre> a\n  b </pre></article>", "one\ntwo\n1\n2\n3\na b"),
    ("<article><p><b>bold <i>it</b> alic</p><p>next</article></div></p>end", "bold it alic\nnext"),
    ("<article><a title=\"a > b\" href=x>link</a> and <span>more</span>&nbsp;&nbsp;text</article>", "link and more text"),
    ("<script>never closed <article><p>x</p></article>", ""),
    ("<div><div><p>deep" * 300, "\n".join(["deep"] * 300)),
    ("<article>" + "word " * 40000 + "</article>", ("word " * 40000).strip()),
]


@pytest.mark.parametrize("source,text", CASES)
def test_pages(source, text):
    assert main_text(source, set()) == text


def site(host, n, body):
    return [(f"http://{host}/{i}", f"<html><body><div class=x1>Welcome to {host}</div>{body(i)}<div>All rights</div></body></html>") for i in range(n)]


def test_template_of_a_host(spark):
    pages = site("A.example", 8, lambda i: f"<div><p>first {i}</p><p>second {i * 7}</p></div>")
    pages += site("copies.example", 5, lambda i: "<div><p>always the same</p></div>")
    pages += site("few.example", 2, lambda i: f"<p>only {i}</p>")
    pages += [(None, None), (None, "<p>no url</p>"), ("http://a.example/9", ""), pages[0]]
    rows = [(i, u, h, "clash", "t") for i, (u, h) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, template string").repartition(3)
    got = {r.page_id: (r.url, r.text) for r in html_extract.extract_text(frame).collect()}
    assert len(got) == len(pages)
    for i in range(8):
        assert got[i] == (f"http://A.example/{i}", f"first {i}\nsecond {i * 7}")
    assert got[8][1] == "Welcome to copies.example\nalways the same\nAll rights"
    assert got[13][1] == "Welcome to few.example\nonly 0\nAll rights"
    assert [got[i][1] for i in range(15, 19)] == ["", "no url", "", "first 0\nsecond 0"]
    assert html_extract.extract_text(frame.limit(0)).collect() == []


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not found")
def test_pages_give_their_documents(spark):
    squeeze = lambda text: " ".join(text.split())
    documents = {squeeze(r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect() if r.text}
    got = queries.QUERIES["op10_html_text"](spark, SF_DIR).collect()
    assert len(got) == 250
    for row in got:
        assert squeeze(row.text.split("\n", 1)[1]) in documents and row.n_chars == len(row.text)


def test_classes_are_ordered_nested_and_told_apart_by_slots():
    classes = {t: (1, rank, 3, 9) for rank, t in enumerate((10, 11, 12))} | {20: (2, 0, 2, 8), 21: (2, 1, 2, 8)}
    assert html_extract.out_of_order([10, 5, 11, 12, 10, 11, 5, 12], classes) == set()
    assert html_extract.out_of_order([11, 12, 10, 20, 21], classes) == {10}
    crossed = lambda tokens: [pair for *_, pairs in html_extract.walk(tokens, classes) for pair in pairs]
    assert crossed([10, 20, 21, 11, 20, 21, 12]) == [] and crossed([10, 20, 11, 21, 12]) == [(1, 2)]
    first, second, third, outside = (html_extract.roles(x, classes)[x.index(5)] for x in ([10, 5, 11, 12], [10, 11, 5, 12], [10, 20, 5, 21, 11, 12], [10, 11, 12, 5]))
    assert len({first, second, third, outside}) == 4 and outside == 5


def test_template_takes_only_classes_in_order(spark):
    # "Topic" and "Place" stand on all pages, in either order; "Note" stands once in the frame and as often as it likes in the text.
    def body(i):
        moved = ["<p>Topic</p>", "<p>Place</p>"][:: 1 if i % 2 else -1]
        return f"<p>Note</p><hr><p>first {i}</p>{moved[0]}<p>then {i}</p>{moved[1]}" + "<p>Note</p>" * (i % 3)

    pages = [(i, f"http://h.example/{i}", f"<body><h2>Welcome</h2>{body(i)}<h3>All rights</h3></body>") for i in range(9)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text.split("\n") for r in html_extract.extract_text(frame).collect()}
    for i in range(9):
        moved = ["Topic", "Place"][:: 1 if i % 2 else -1]
        # One of the two keeps the order of the class with the frame, the other is text.
        left = [x for x in got[i] if x in moved]
        assert len(left) == 1 and left == [x for x in got[0] if x in moved]
        assert [x for x in got[i] if x not in moved] == [f"first {i}", f"then {i}"] + ["Note"] * (i % 3)


def test_what_repeats_is_worked_out_once():
    page = "<article><div class='site-nav'>menu</div><div id=x>text</div>" + f"<div class='{'y ' * 400}nav'>long</div></article>"
    first = html_extract.read_page(page)
    assert [(text, outside) for _, text, in_main, outside in first if text] == [("menu", True), ("text", False), ("long", True)]
    tokens, known = html_extract.page_tokens(first), html_extract._element.cache_info()
    assert html_extract.read_page(page) == first and html_extract.page_tokens(first) == tokens
    again = html_extract._element.cache_info()
    assert again.misses == known.misses and again.hits == known.hits + 3
    assert tokens == [html_extract.token(*((path,) if text is None else (path, text))) for path, text, *_ in first]
