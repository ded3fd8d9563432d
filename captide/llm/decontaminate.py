"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted-shingle similarity.

Texts are words (letters, digits and marks, lower case). For every length of an item, windows of that many words slide
over each document. A window is fingerprinted if the item shingles in it weigh enough for the similarity asked for; no
other window could pass the last test. Its 64-bit SimHash is looked up in an index of ``RADIUS + 1`` blocks of bits
over the items of that length: two fingerprints within the radius agree in one block, so all items within it are met.
Each of them is then compared by its weighted 5-word shingles: the weight of those in common against the weight of
those in either, where a shingle weighs as many characters as its words have.

Items are a stated query set: they are taken to the tasks in portions of at most ``PORTION`` characters, as many
portions as there are, and documents are never shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from captide.llm.common import WORD_HASHES, documents_of, staged

WORDS = 5
PERCENT = 80
RADIUS = 11
PORTION = 8 * 1024 * 1024

_words_of = re.compile(r"\w+").findall
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, WORDS)]
_FILTER_BITS = 22


def read(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a text's words and their lengths."""
    words = _words_of((text or "").lower())
    codes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    return codes, np.fromiter(map(len, words), np.int64, len(words))


def shingled(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the weight of the shingle at each word that has one."""
    n = len(codes) - WORDS + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = codes[:n].copy()
    for k, power in enumerate(_POWERS, 1):
        h += codes[k : n + k] * power
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    weights = sum(sizes[k : n + k] for k in range(WORDS))
    return h, weights


def fingerprints(codes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The SimHash of the ``length`` words from each start, by running sums of the words' bits."""
    out = np.empty(len(starts), np.uint64)
    # Stretches keep the table of sums small, however long the text is.
    for low in range(0, len(starts), 4096):
        some = starts[low : low + 4096]
        order = np.argsort(some, kind="stable")
        some = some[order]
        cuts = np.flatnonzero(np.diff(some) > 8192) + 1
        found = np.empty(len(some), np.uint64)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(some)]):
            first, last = int(some[a]), int(some[b - 1]) + length
            bits = np.unpackbits(codes[first:last].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.zeros((len(bits) + 1, 64), np.int32)
            np.cumsum(bits, axis=0, out=sums[1:])
            at = some[a:b] - first
            majority = 2 * (sums[at + length] - sums[at]) > length
            found[a:b] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).reshape(-1)
        out[low : low + 4096][order] = found
    return out


def block_edges() -> list[tuple[int, int]]:
    """The bits of each block: ``(first, width)``."""
    ends = [64 * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


class HammingIndex:
    """Fingerprints filed under the value of each of ``RADIUS + 1`` blocks of bits."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.blocks = []
        for first, width in block_edges():
            part = self._part(values, first, width)
            order = np.argsort(part, kind="stable")
            starts = np.searchsorted(part[order], np.arange((1 << width) + 1))
            self.blocks.append((first, width, order, starts))

    @staticmethod
    def _part(values, first, width):
        return (values >> np.uint64(first)).astype(np.int64) & ((1 << width) - 1)

    def within(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs ``(place in asked, place in values)`` within the radius, once each."""
        pairs = []
        for first, width, order, starts in self.blocks:
            part = self._part(asked, first, width)
            counts = starts[part + 1] - starts[part]
            left = np.repeat(np.arange(len(asked)), counts)
            within = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts)
            right = order[np.repeat(starts[part], counts) + within]
            close = np.bitwise_count(asked[left] ^ self.values[right]) <= RADIUS
            pairs.append(left[close] * len(self.values) + right[close])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.values), both % len(self.values)


class Items:
    """One portion of items, ready to be searched for."""

    def __init__(self, rows: list[tuple]):
        self.by_length: dict[int, list] = {}
        self.sets: list[tuple[object, dict[int, int], int]] = []
        hashes = []
        for item_id, text in rows:
            codes, sizes = read(text)
            h, weights = shingled(codes, sizes)
            if len(h):
                own = dict(zip(h.tolist(), weights.tolist()))
                mark = fingerprints(codes, np.zeros(1, np.int64), len(codes))[0]
                self.by_length.setdefault(len(codes), []).append((len(self.sets), mark))
                self.sets.append((item_id, own, sum(own.values())))
                hashes.append(h)
        self.hashes = np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64)
        self.sieve = np.zeros(1 << _FILTER_BITS, bool)
        self.sieve[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.lengths = []
        for length, filed in sorted(self.by_length.items()):
            members = np.array([n for n, _ in filed])
            lightest = min(self.sets[n][2] for n in members)
            self.lengths.append((length, members, lightest, HammingIndex(np.array([m for _, m in filed], np.uint64))))

    def found_in(self, text: str | None) -> list[tuple]:
        """``(item_id, start, n_words, common, union)``: the best window of a text for each item it holds."""
        codes, sizes = read(text)
        h, weights = shingled(codes, sizes)
        hits = self.sieve[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
        places = np.flatnonzero(hits)
        if not len(places):
            return []
        spots = np.minimum(np.searchsorted(self.hashes, h[places]), len(self.hashes) - 1)
        places = places[self.hashes[spots] == h[places]]
        if not len(places):
            return []
        heavy = np.zeros(len(h) + 1, np.int64)
        heavy[places + 1] = weights[places]
        heavy = np.cumsum(heavy)
        best: dict[int, tuple] = {}
        for length, members, lightest, index in self.lengths:
            last = len(codes) - length
            if last < 0:
                break
            inner = length - WORDS + 1
            starts = np.flatnonzero(100 * (heavy[inner : inner + last + 1] - heavy[: last + 1]) >= PERCENT * lightest)
            if not len(starts):
                continue
            asked, answers = index.within(fingerprints(codes, starts, length))
            for start, n in zip(starts[asked].tolist(), members[answers].tolist()):
                window = dict(zip(h[start : start + inner].tolist(), weights[start : start + inner].tolist()))
                _, own, total = self.sets[n]
                common = sum(w for s, w in window.items() if s in own)
                union = total + sum(window.values()) - common
                # The highest share of common weight wins, then the first window.
                if 100 * common >= PERCENT * union and (n not in best or common * best[n][3] > best[n][2] * union):
                    best[n] = (start, length, common, union)
        return [(self.sets[n][0], *best[n]) for n in sorted(best)]


def _portions(items: DataFrame):
    """The items in the order of their ids, in lists of bounded size."""
    portion, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        portion.append((row.item_id, row.text))
        size += len(row.text)
        if size >= PORTION:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity``: every document that holds an item, with its best window.

    ``start`` and ``n_words`` count words of the document. Items of fewer than 5 words are too short to tell and are
    not searched for; null and empty texts hold nothing and are no items; texts of any length are searched whole;
    items with equal texts are all reported; repeated rows give repeated rows; an empty table on either side gives
    none. Other columns are not carried.
    """
    texts = documents_of(docs, id_column, text_column)
    items = benchmark.select(F.col(item_column).alias("item_id"), F.col(item_text_column).cast("string").alias("text")).where("text IS NOT NULL")
    doc_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((texts, "doc_id"), (items, "item_id")))
    schema = f"doc_id {doc_type}, item_id {item_type}, start bigint, n_words bigint, similarity double"
    item_kind = to_arrow_type(items.schema["item_id"].dataType)
    found = [_search(texts, portion, schema, item_kind) for portion in _portions(items)]
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], schema)


def _search(texts: DataFrame, portion: list[tuple], schema: str, item_kind: pa.DataType) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(portion)
    names = ["doc_id", "item_id", "start", "n_words", "similarity"]

    def scan(batches):
        items = Items(shared.value)
        for batch in batches:
            at, rows = [], []
            for place, text in enumerate(batch.column("text").to_pylist()):
                for found in items.found_in(text):
                    at.append(place)
                    rows.append(found)
            item, start, length, common, union = zip(*rows) if rows else [()] * 5
            columns = [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(item, item_kind), pa.array(start, pa.int64())]
            columns += [pa.array(length, pa.int64()), pa.array([c / u for c, u in zip(common, union)], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.mapInArrow(scan, schema)


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, as they are; rows that share an id are judged each by its own text."""
    body = lambda df: F.xxhash64(df[text_column].cast("string"))
    named = docs.select(F.struct(docs[id_column].alias("id"), body(docs).alias("body")).alias("doc_id"), docs[text_column].alias("text"))
    leaks = staged(find_leaks(named, benchmark).select("doc_id.id", "doc_id.body").distinct(), "leaks")
    return docs.join(leaks, docs[id_column].eqNullSafe(leaks["id"]) & (body(docs) == leaks["body"]), "left_anti")
