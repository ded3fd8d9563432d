"""Metadata documents: XML bytes to a map of tag values, and folds over that map."""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captide.functions.documents import inflate

TAG_MAP = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
PARSED_TAGS = T.StructType(
    [
        T.StructField("tags", TAG_MAP),
        T.StructField("error", T.StringType()),
        T.StructField("truncated", T.BooleanType()),
    ]
)
_ARROW_TAGS = pa.struct(
    [
        ("tags", pa.map_(pa.string(), pa.list_(pa.string()))),
        ("error", pa.string()),
        ("truncated", pa.bool_()),
    ]
)


class _TagReader:
    """Collects leaf values of one document; nothing is kept between documents.

    A closing element counts as a leaf when no other element was opened since it
    was. Text is stripped and blank pieces are left out. ``compat`` treats every
    call of the XML library as a piece of its own, which breaks the text at
    entities and line ends; otherwise a piece is the whole run up to the next tag.
    """

    def __init__(self, compat: bool):
        self.values: dict[str, list[str]] = {}
        self.compat = compat
        self._newest = None
        self._run: list[str] = []
        self._pieces: list[str] = []

    def text(self, data):
        self._run.append(data)
        if self.compat:
            self._settle()

    def opened(self, name, _attributes):
        self._settle()
        self._newest = name

    def closed(self, name):
        self._settle()
        if name == self._newest:
            self.values.setdefault(name, []).append("\n".join(self._pieces))
            self._pieces.clear()
            self._newest = None

    def _settle(self):
        piece = "".join(self._run).strip()
        self._run.clear()
        if piece:
            self._pieces.append(piece)


def read_tags(content: bytes, compat: bool = False) -> dict:
    """Tag values of one XML document, or the reason why it cannot be parsed.

    A document that ends early keeps the values closed so far and is flagged.
    """
    reader = _TagReader(compat)
    parser = expat.ParserCreate()
    parser.StartElementHandler = reader.opened
    parser.EndElementHandler = reader.closed
    parser.CharacterDataHandler = reader.text
    try:
        parser.Parse(inflate(content))
    except Exception as problem:
        return {"tags": None, "error": f"{type(problem).__name__}: {problem}", "truncated": None}
    # Closing the parser may not add values: an early end is only flagged.
    parser.StartElementHandler = parser.EndElementHandler = parser.CharacterDataHandler = None
    try:
        parser.Parse(b"", True)
        truncated = False
    except expat.ExpatError:
        truncated = True
    return {"tags": list(reader.values.items()), "error": None, "truncated": truncated}


def _tag_udf(compat: bool):
    @F.arrow_udf(returnType=PARSED_TAGS)
    def parse_tags(content: pa.Array) -> pa.Array:
        rows = (read_tags(doc, compat) if doc is not None else None for doc in content.to_pylist())
        return pa.array(rows, type=_ARROW_TAGS)

    # Kept out of filter pushdown, which would otherwise parse each document twice.
    return parse_tags.asNondeterministic()


def parse_tags(content: Column, compat: bool = False) -> Column:
    """``STRUCT<tags MAP<STRING, ARRAY<STRING>>, error, truncated>`` of an XML document."""
    return _tag_udf(compat)(content)


def fold_tags(tags: Column) -> Column:
    """Repeated values of each tag joined by ``|`` in document order."""
    return F.transform_values(tags, lambda _tag, values: F.array_join(values, "|"))


def tag_value(tags: Column, tag: str) -> Column:
    """One folded tag; NULL where the document has none."""
    return F.array_join(F.try_element_at(tags, F.lit(tag)), "|")
