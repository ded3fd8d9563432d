"""Removal of every byte that a repeated string of ``LENGTH`` bytes covers.

A window is a string of ``LENGTH`` bytes inside one document. Its anchor is the place in it whose ``GRAM`` bytes hash
lowest (the first of equals), so equal windows have their anchors at equal places, with equal grams around them.
Neighbouring windows share an anchor: a document of n bytes has about ``2 n / (LENGTH - GRAM)`` of them, and those, not
its n suffixes, are sorted and compared.

1. For each anchor the *stretch* of all its windows is hashed. Anchors are grouped by gram. An anchor alone in its group has no
   repeated window. If its whole stretch occurs twice, all its windows are repeated.
2. The other groups are dealt out by gram, and settled by suffix sorting with a difference cover: over the stretches of a
   task's groups, the suffixes at places 1 and 2 modulo 3 are sorted by their triples, by recursion on the names of
   the triples where these are not unique; the remaining suffixes are sorted by their first byte and the rank that
   follows, and merged in. Windows with equal bytes are then neighbours, and each is compared with the adjacent one.
3. Groups of more than ``GROUP`` different stretches are settled by an aggregate over window hashes instead, so no group meets in
   one task. Windows of repeated places become spans, and the spans of a document are cut out.

Hashes are two independent 64-bit ones. Why not all suffixes of the corpus are sorted is said in the README, with figures.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import documents_of, staged

LENGTH = 400
GRAM = 64
# A task sorts fewer than BATCH + GROUP stretches of less than 2 * LENGTH bytes at once: fewer than 2 ** 21 bytes.
GROUP = 1500
BATCH = 1000

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_M64 = (1 << 64) - 1


@lru_cache(maxsize=2)
def _letters(which: int) -> np.ndarray:
    """A fixed odd-looking 64-bit number for each byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[which])
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a base and of its inverse modulo 2 ** 64."""
    held = _powers.get(which)
    if held is None or len(held[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        pair = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
            pair.append(out)
        held = _powers[which] = (pair[0], pair[1])
    return held


class Hashed:
    """Hashes of any substring of a string of bytes, from running sums."""

    def __init__(self, data: np.ndarray, both: bool = True):
        self.sums = []
        for which in (0, 1) if both else (0,):
            powers = _powers_of(which, len(data) + 1)[0]
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_letters(which)[data] * powers[: len(data)], out=sums[1:])
            self.sums.append(sums)

    def of(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        inverse = _powers_of(which, len(sums))[1]
        h = (sums[ends] - sums[starts]) * inverse[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, _M64, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    onwards = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(onwards[: n - width + 1], upto[width - 1 : n])


def anchors_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each anchor: its place, its first and last window, the hash of its gram and two of its stretch."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64))
    hashed = Hashed(data)
    places = np.arange(n - GRAM + 1)
    grams = hashed.of(0, places, places + GRAM)
    keys = (grams & np.uint64(_M64 ^ 0xFFFFFFFF)) | places.astype(np.uint64)
    least = (_sliding_least(keys, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    firsts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    lasts = np.append(firsts[1:], len(least)) - 1
    at = least[firsts]
    return at, firsts, lasts, grams[at], hashed.of(0, firsts, lasts + LENGTH), hashed.of(1, firsts, lasts + LENGTH)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def anchors(texts: DataFrame) -> DataFrame:
    """``doc_id, body, first, last, gram, s1, s2`` of every anchor of ``doc_id, body, text``."""

    def scan(batches):
        for batch in batches:
            rows, columns = [], [[] for _ in range(5)]
            for row, text in enumerate(batch.column("text").to_pylist()):
                _, *found = anchors_of(_bytes(text))
                rows.append(np.full(len(found[0]), row))
                for column, values in zip(columns, found):
                    column.append(values)
            take = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            arrays = [pa.array(np.concatenate(c).view(np.int64) if c else [], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("body").take(take), *arrays],
                names=["doc_id", "body", "first", "last", "gram", "s1", "s2"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(scan, f"doc_id {kind}, body bigint, first bigint, last bigint, gram bigint, s1 bigint, s2 bigint")


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def windows_of(stretches: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of all windows of some stretches: the stretch, the place in it, the place in all of them, and two hashes."""
    sizes = np.array([len(s) for s in stretches])
    hashed = Hashed(np.frombuffer(b"".join(stretches), np.uint8))
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(stretches)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = place + np.repeat(np.cumsum(sizes) - sizes, counts)
    return owner, place, starts, hashed.of(0, starts, starts + LENGTH), hashed.of(1, starts, starts + LENGTH)


def suffix_order(t: np.ndarray) -> np.ndarray:
    """The suffixes of ``t`` (numbers from 1 up, below 2 ** 21, fewer than 2 ** 21) in order, by the cover {1, 2} modulo 3."""
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    s = np.concatenate((t, [0, 0, 0, 0])).astype(np.uint64)
    # If the last place is 0 modulo 3, an empty suffix ends the first half of the sample.
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    triples = s[sample] << np.uint64(42) | s[sample + 1] << np.uint64(21) | s[sample + 2]
    distinct, names = np.unique(triples, return_inverse=True)
    if len(distinct) < len(sample):
        order = suffix_order(names + 1)
        names = np.empty(len(sample), np.int64)
        names[order] = np.arange(len(sample))
    else:
        order = np.argsort(names)
    rank = np.zeros(n + 4, np.uint64)
    rank[sample] = (names + 1).astype(np.uint64)
    sample = sample[order]
    sample = sample[sample < n]
    short = lambda i: s[i] << np.uint64(42) | rank[i + 1]
    long = lambda i: s[i] << np.uint64(42) | s[i + 1] << np.uint64(21) | rank[i + 2]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(short(rest))]
    # Among the suffixes 1 modulo 3 the next rank decides, among those 2 modulo 3 the one after.
    before = np.searchsorted(short(sample[sample % 3 == 1]), short(rest)) + np.searchsorted(long(sample[sample % 3 == 2]), long(rest))
    out = np.full(n, -1, np.int64)
    out[np.arange(len(rest)) + before] = rest
    out[out < 0] = sample
    return out


def repeated_windows(order: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which windows have an equal one: each is compared with the adjacent one in suffix order."""
    a, b = h1[order], h2[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    out = np.zeros(len(h1), bool)
    out[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    return out


def _settled(members: DataFrame) -> DataFrame:
    """``doc_id, body, start, end``: spans of repeated windows, groups of ``gram`` taken whole by a task each."""

    def scan(batches):
        held, last, kind = [], None, None

        def spans():
            stretches = [row[4] for row in held]
            owner, place, starts, h1, h2 = windows_of(stretches)
            order = suffix_order(np.frombuffer(b"".join(stretches), np.uint8).astype(np.int64) + 1)
            # Of all places, those where a window starts, by its number.
            number = np.full(len(order), -1, np.int64)
            number[starts] = np.arange(len(starts))
            order = number[order]
            flags = repeated_windows(order[order >= 0], h1, h2)
            out = []
            # A run of windows does not cross stretches: their first windows begin a run of their own.
            cut = np.flatnonzero(np.diff(owner)) + 1
            for k, part in enumerate(np.split(flags, cut)):
                doc_id, body, first, done, _ = held[k]
                if not done:
                    out += [(doc_id, body, first + int(a), first + int(b) - 1 + LENGTH) for a, b in zip(*runs(part))]
            held.clear()
            columns = list(zip(*out)) or [()] * 4
            kinds = (kind, pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "body", "start", "end"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            names = ("gram", "doc_id", "body", "first", "done", "stretch")
            for gram, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if gram != last and len(held) >= BATCH:
                    yield spans()
                last = gram
                held.append(row)
        if held:
            yield spans()

    kind = members.schema["doc_id"].dataType.simpleString()
    dealt = members.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(scan, f"doc_id {kind}, body bigint, start bigint, end bigint")


def _settled_apart(members: DataFrame) -> DataFrame:
    """The same for groups of any size: windows are rows, counted by their hashes."""

    def scan(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, place, _, h1, h2 = windows_of(batch.column("stretch").to_pylist())
            take = pa.array(owner, pa.int64())
            first = np.array(batch.column("first").to_pylist())[owner] + place
            arrays = [batch.column(c).take(take) for c in ("doc_id", "body", "done")]
            arrays += [pa.array(first, pa.int64()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "body", "done", "start", "h1", "h2"])

    kind = members.schema["doc_id"].dataType.simpleString()
    windows = members.mapInArrow(scan, f"doc_id {kind}, body bigint, done boolean, start bigint, h1 bigint, h2 bigint")
    repeated = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    found = windows.where("NOT done").join(repeated, ["h1", "h2"], "left_semi")
    return found.select("doc_id", "body", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``doc_id, body, start, end``: spans, overlapping or not, that cover what is repeated in ``texts``."""
    found = anchors(texts)
    stretches = found.groupBy("gram", "s1", "s2").agg(F.count("*").alias("n"))
    groups = stretches.groupBy("gram").agg(F.sum("n").alias("copies"), F.count("*").alias("total"), F.min("n").alias("least"))
    groups = groups.where("copies > 1").drop("copies")
    known = stretches.join(groups, "gram").select("gram", "s1", "s2", "n", "total", "least")
    matched = staged(found.join(known, ["gram", "s1", "s2"]).select("doc_id", "body", "first", "last", "gram", "n", "total", "least"), "anchors")
    whole = matched.where("n > 1").select("doc_id", "body", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))

    # Groups in which some stretch stands alone are settled by their windows; the others are done.
    unsettled = matched.where("least = 1").groupBy("doc_id", "body").agg(
        F.collect_list(F.struct("gram", "total", (F.col("n") > 1).alias("done"), "first", "last")).alias("parts")
    )
    t, p = texts.alias("t"), unsettled.alias("p")
    rows = t.join(p, F.expr("t.doc_id <=> p.doc_id AND t.body = p.body")).select("t.doc_id", "t.body", "t.text", "p.parts")

    def cut(batches):
        for batch in batches:
            at, out = [], []
            for row, (text, parts) in enumerate(zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist())):
                data = text.encode()
                for part in parts:
                    at.append(row)
                    out.append((part["gram"], part["total"], part["done"], part["first"], data[part["first"] : part["last"] + LENGTH]))
            take = pa.array(at, pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("body").take(take), *columns],
                names=["doc_id", "body", "gram", "total", "done", "first", "stretch"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, body bigint, gram bigint, total bigint, done boolean, first bigint, stretch binary"
    cut_out = staged(rows.mapInArrow(cut, schema), "stretches")
    # Of a stretch that is done, one copy is enough for the others of its group to be compared with.
    nothing = [F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("bigint").alias("body")]
    witnesses = cut_out.where("done").select("gram", "total", "stretch").distinct()
    witnesses = witnesses.select(*nothing, "gram", "total", F.lit(True).alias("done"), F.lit(0).cast("bigint").alias("first"), "stretch")
    members = cut_out.where("NOT done").union(witnesses)
    spans = whole.union(_settled(members.where(F.col("total") <= GROUP)))
    large = members.where(F.col("total") > GROUP)
    return spans if large.isEmpty() else spans.union(_settled_apart(large))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed spans (merged, in bytes) and the bytes that stay.

    A null text counts as empty. Texts of fewer than ``LENGTH`` bytes lose nothing. Repeated rows are repeats of each
    other, so rows of equal texts of ``LENGTH`` bytes or more lose all. Texts of any length are treated whole; an empty
    table gives no rows. Other columns are not carried. Removed bytes may split a character, so ``kept`` is binary.
    """
    texts = documents_of(docs, id_column, text_column).withColumn("text", F.coalesce("text", F.lit("")))
    texts = texts.select("doc_id", F.xxhash64("text").alias("body"), "text")
    spans = repeated_spans(texts).groupBy("doc_id", "body").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    t, s = texts.alias("t"), spans.alias("s")
    rows = t.join(s, F.expr("t.doc_id <=> s.doc_id AND t.body = s.body"), "left").select("t.doc_id", "t.text", "s.spans")

    def cut(batches):
        for batch in batches:
            sizes, merged, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data = text.encode()
                gone = np.zeros(len(data) + 1, np.int32)
                for span in spans or ():
                    gone[span["start"]] += 1
                    gone[span["end"]] -= 1
                flags = np.cumsum(gone)[:-1] > 0
                sizes.append(len(data))
                merged.append([{"start": int(a), "end": int(b)} for a, b in zip(*runs(flags))])
                kept.append(np.frombuffer(data, np.uint8)[~flags].tobytes())
            pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(merged, pair), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
