"""Caption pages: HTML bytes to snippet texts and to timed segments."""

from __future__ import annotations

import re
from collections import Counter
from html import entities
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captide.editions import Edition
from captide.functions.documents import decode_page, inflate

# Class names of a caption container and of its text.
CONTAINER_CLASS = "tvcol"
SNIPPET_CLASSES = ["snipin", "nosel"]

# HTML elements without content.
VOID_ELEMENTS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
# Markup so plain that there is only one way to read it: text, an opening tag (name,
# attributes, slash), a closing tag, two forms of entity, a comment or doctype, and a
# script or style. Elements whose content may be read in several ways are left out.
_ATTRIBUTES = r"""(?:[ \t\n]+[a-z][a-z0-9_-]*(?:="[^"]*"|='[^']*')?)*"""
_PLAIN = re.compile(
    r"([^<&]+)"
    r"|<(?!(?:iframe|noembed|noframes|noscript|plaintext|script|style|textarea|title|xmp)\b)"
    rf"([a-z][a-z0-9]*)({_ATTRIBUTES})[ \t\n]*(/?)>"
    r"|</([a-z][a-z0-9]*)>"
    r"|&([a-z][a-z0-9]*);"
    r"|&\#([0-9]+|x[0-9a-f]+);"
    r"|(<!--(?!-?>)[^-]*(?:-[^-]+)*-->|<!doctype[^<>]*>)"
    rf"|<(script|style){_ATTRIBUTES}>[^<]*(?:<(?![/!])[^<]*)*</\9>",
    re.IGNORECASE | re.ASCII,
)
_TEXT, _OPENING, _CLOSING, _ENTITY, _NUMBER, _REMARK, _SILENT = 1, 4, 5, 6, 7, 8, 9
_PLAIN_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9_-]*)(?:="([^"]*)"|='([^']*)')?""", re.IGNORECASE | re.ASCII)
_TAG_START = re.compile(r"</?[a-z]", re.IGNORECASE | re.ASCII)

# Elements whose text is not part of the page's readable text.
SILENT_ELEMENTS = frozenset("rp rt script style template".split())


class _CaptionReader(HTMLParser):
    """One pass over a page; keeps the open elements and the texts being read.

    A closing tag closes everything opened since its opening tag and is ignored
    when there is none, so an unclosed inline tag ends with its container.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.snippets: list[list[str]] = []
        self.containers: list[dict] = []
        self._open: list[tuple[str, list[str] | None, dict | None]] = []
        self._open_names = Counter()
        self._texts: list[list[str]] = []
        self._linkless: list[dict] = []
        self._textless: list[dict] = []
        self._silent = 0
        self._run: list[str] = []

    def goahead(self, end):
        """Read plain markup with one match each; leave other tags, and the rest of a
        page behind anything stranger, to the library."""
        page, at = self.rawdata, 0
        while not end and at < len(page):
            plain = _PLAIN.match(page, at)
            if plain is None:
                read = self._read_tag(at)
                if read < 0 or self.cdata_elem is not None:
                    at = max(at, read)
                    break
                at = read
                continue
            at = plain.end()
            kind = plain.lastindex
            if kind == _TEXT:
                if self._texts and not self._silent:
                    self._run.append(plain.group())
            elif kind == _OPENING:
                name, written, closed = plain.group(2, 3, 4)
                name = name.lower()
                matters = name == "div" or name == "a" and self._linkless
                if matters and "&" in written:
                    self.parse_starttag(plain.start())
                elif closed:
                    self.handle_startendtag(name, _attributes(written) if matters else ())
                else:
                    self.handle_starttag(name, _attributes(written) if matters else ())
            elif kind == _CLOSING:
                self.handle_endtag(plain.group(5).lower())
            elif kind == _ENTITY:
                self.handle_entityref(plain.group(6))
            elif kind == _NUMBER:
                self.handle_charref(plain.group(7))
            else:
                self._end_text()
        self.rawdata = page[at:]
        super().goahead(end)

    def _read_tag(self, at):
        """The end of a tag that the library can read, or -1."""
        if not _TAG_START.match(self.rawdata, at):
            return -1
        return self.parse_endtag(at) if self.rawdata[at + 1] == "/" else self.parse_starttag(at)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        if tag in VOID_ELEMENTS:
            return
        text = container = None
        if tag == "a" and self._linkless:
            href = dict(attrs).get("href", False)
            for waiting in self._linkless:
                waiting["href"] = "" if href is None else href
            self._linkless.clear()
        elif tag == "div":
            classes = (dict(attrs).get("class") or "").split()
            if classes == SNIPPET_CLASSES:
                text = []
                self.snippets.append(text)
                self._texts.append(text)
                for waiting in self._textless:
                    waiting["text"] = text
                self._textless.clear()
            elif CONTAINER_CLASS in classes:
                container = {"href": None, "text": None}
                self.containers.append(container)
                self._linkless.append(container)
                self._textless.append(container)
        elif tag in SILENT_ELEMENTS:
            self._silent += 1
        self._open.append((tag, text, container))
        self._open_names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        if not self._open_names[tag]:
            return
        closed = None
        while closed != tag:
            closed, text, container = self._open.pop()
            self._open_names[closed] -= 1
            if closed in SILENT_ELEMENTS:
                self._silent -= 1
            if text is not None:
                self._texts.pop()
            if container is not None:
                # Inner containers closed before, so it can only be the last one.
                for waiting in (self._linkless, self._textless):
                    if waiting and waiting[-1] is container:
                        waiting.pop()

    def handle_data(self, data):
        if self._texts and not self._silent:
            self._run.append(data)

    def handle_charref(self, name):
        try:
            number = int(name[1:], 16) if name[0] in "xX" else int(name)
            # Codes below 256 mean windows-1252, as browsers read them.
            self.handle_data(bytes([number]).decode("windows-1252") if number < 256 else _character(number))
        except UnicodeDecodeError:
            self.handle_data(chr(number))
        except ValueError:
            self.handle_data("�")

    def handle_entityref(self, name):
        self.handle_data(entities.html5.get(f"{name};", f"&{name}"))

    def handle_comment(self, data):
        self._end_text()

    def handle_decl(self, decl):
        self._end_text()

    def handle_pi(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA[") :])
            self._end_text()

    def _end_text(self):
        if self._run:
            node = "".join(self._run).strip()
            self._run.clear()
            if node:
                for text in self._texts:
                    text.append(node)

    def read(self, content: bytes):
        self.feed(decode_page(inflate(content)))
        self.close()
        self._end_text()
        return self


def _attributes(written: str) -> list[tuple[str, str | None]]:
    return [
        (name.lower(), single if double is None else double)
        for name, double, single in (found.groups() for found in _PLAIN_ATTRIBUTE.finditer(written))
    ]


def _character(number: int) -> str:
    if number > 0x10FFFF or 0xD800 <= number <= 0xDFFF:
        return "�"
    return chr(number)


def read_snippets(content: bytes) -> dict:
    """Texts of all snippet elements of one page, in document order."""
    try:
        page = _CaptionReader().read(content)
    except Exception as problem:
        return {"snippets": None, "error": f"{type(problem).__name__}: {problem}"}
    return {"snippets": [" ".join(text) for text in page.snippets], "error": None}


def read_containers(content: bytes) -> dict:
    """Link and first snippet of every caption container of one page.

    A container without a link, or whose link leads nowhere, spoils the page.
    """
    try:
        page = _CaptionReader().read(content)
    except Exception as problem:
        return {"containers": None, "error": f"{type(problem).__name__}: {problem}"}
    for container in page.containers:
        if container["href"] is None:
            return {"containers": None, "error": "container without link"}
        if container["href"] is False:
            return {"containers": None, "error": "link without href"}
    containers = [
        {"pos": pos, "href": c["href"], "text": None if c["text"] is None else " ".join(c["text"])}
        for pos, c in enumerate(page.containers)
    ]
    return {"containers": containers, "error": None}


PARSED_SNIPPETS = T.StructType(
    [T.StructField("snippets", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())]
)
_ARROW_SNIPPETS = pa.struct([("snippets", pa.list_(pa.string())), ("error", pa.string())])

CONTAINER = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("href", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
PARSED_CONTAINERS = T.StructType(
    [T.StructField("containers", T.ArrayType(CONTAINER)), T.StructField("error", T.StringType())]
)
_ARROW_CONTAINERS = pa.struct(
    [
        ("containers", pa.list_(pa.struct([("pos", pa.int32()), ("href", pa.string()), ("text", pa.string())]))),
        ("error", pa.string()),
    ]
)


@F.arrow_udf(returnType=PARSED_SNIPPETS)
def _snippets_udf(content: pa.Array) -> pa.Array:
    rows = (read_snippets(page) if page is not None else None for page in content.to_pylist())
    return pa.array(rows, type=_ARROW_SNIPPETS)


@F.arrow_udf(returnType=PARSED_CONTAINERS)
def _containers_udf(content: pa.Array) -> pa.Array:
    rows = (read_containers(page) if page is not None else None for page in content.to_pylist())
    return pa.array(rows, type=_ARROW_CONTAINERS)


# Kept out of filter pushdown, which would otherwise parse each page twice.
_snippets_udf = _snippets_udf.asNondeterministic()
_containers_udf = _containers_udf.asNondeterministic()


def parse_snippets(content: Column) -> Column:
    """``STRUCT<snippets ARRAY<STRING>, error>`` of a caption page."""
    return _snippets_udf(content)


def parse_containers(content: Column) -> Column:
    """``STRUCT<containers ARRAY<STRUCT<pos, href, text>>, error>`` of a caption page."""
    return _containers_udf(content)


def link_times(href: Column, edition: Edition) -> tuple[Column, Column]:
    """Start and end of a time link in milliseconds; NULL if the link is none."""

    def milliseconds(group: int) -> Column:
        seconds = F.regexp_extract(href, edition.link_pattern, group).try_cast("bigint")
        return F.try_multiply(seconds, F.lit(1000).cast("bigint"))

    return milliseconds(1), milliseconds(2)


def timed_segments(containers: Column, edition: Edition) -> Column:
    """``ARRAY<STRUCT<pos, start_ms, end_ms, text>>``: the containers with a time link."""

    def segment(container: Column) -> Column:
        start_ms, end_ms = link_times(container["href"], edition)
        return F.struct(
            container["pos"].alias("pos"),
            start_ms.alias("start_ms"),
            end_ms.alias("end_ms"),
            container["text"].alias("text"),
        )

    timed = F.filter(containers, lambda container: container["href"].rlike(edition.link_pattern))
    return F.transform(timed, segment)
