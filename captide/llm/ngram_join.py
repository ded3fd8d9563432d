"""Documents that share most of their word shingles, found by T-occurrence search.

A document is the set of its 5-word shingles (63-bit hashes); two link if ``100 * common >= 80 * union``. Documents
with equal sets form a class and are one row from then on.

*Candidates.* For a link, the common shingles must reach T. All but T - 1 of a set's inverted lists, the short ones,
have to hold the partner (the L = T - 1 long ones are left for probing). Short and long are told by one order of all
shingles: by the level of their hash bucket, counted over the whole corpus, then by hash. Lists of level 0 are merged
into pair counts, and a pair stays if its count can still reach T. A list of a crowded bucket, which is on the short
side only if a set has little else (a large group of near copies), is a node of the candidate graph: its pairs are
never written out.

*Search.* The connected parts of the candidate graph are blocks (see ``blocks``); the whole sets of a block, or of a
piece of a large one, meet in one task. It runs DivideSkip: merge the short lists, probe the long ones by binary
search, and report links between documents that are not yet connected.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.blocks import links_in_blocks
from captide.llm.common import WORD_HASHES, documents_of, staged
from captide.llm.components import components

WORDS = 5
PERCENT = 80
BLOCK = 1024
BUCKET_BITS = 22
CHUNKS = 64
ROOMY = 16
# A row of the table of candidates has about 60 bytes: at most 30 MB are broadcast, more are shuffled.
BROADCAST_ROWS = 500_000
SALTS = 64
PROBE = 0.0085

_MASK = (1 << 64) - 1
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, WORDS)]


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct 63-bit hashes of a text's shingles; with fewer words, of the whole sequence."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, n)
    if n < WORDS:
        # Its length tells a short sequence from the shingles of others.
        digest = hashlib.blake2b(b" ".join(words), digest_size=8, person=b"short").digest()
        return np.array([int.from_bytes(digest, "little") >> 1], np.uint64)
    h = codes[: n - WORDS + 1].copy()
    for k, power in enumerate(_POWERS, 1):
        h += codes[k : n - WORDS + 1 + k] * power
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h >>= np.uint64(1)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def class_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def short_code(key: bytes) -> int:
    """The first 64 bits of a class key: names a class in the inverted lists, where 16 bytes are too many."""
    return int.from_bytes(key[:8], "little", signed=True)


def needed(n: int, m: int) -> int:
    """The common shingles that sets of ``n`` and ``m`` need for a link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    """How many lists have to be short: all but T - 1, for the smallest partner."""
    return n - -(-PERCENT * n // 100) + 1


def sets_of(texts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n_shingles, key`` of every row, staged, and the level of every hash bucket.

    Every task counts its distinct sets in ``2 ** BUCKET_BITS`` buckets, and the counts of all tasks are added up. A
    bucket far above the mean is crowded; its level is the binary logarithm of its count. Others have level 0.
    """
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        seen, kind = set(), None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            n, keys = [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text)
                n.append(len(values))
                key = class_key(values) if len(values) else None
                keys.append(key)
                if key and key not in seen:
                    seen.add(key)
                    # Two shingles of a set in one bucket count once, which is fine here.
                    counts[(values >> np.uint64(63 - BUCKET_BITS)).astype(np.int64)] += 1
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary())]
            columns += [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "key", "chunk", "counts"])
        if seen:
            parts = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(CHUNKS, -1)]
            empty = [pa.nulls(CHUNKS, t) for t in (kind, pa.int64(), pa.binary())]
            columns = [*empty, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "key", "chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = None, 0
        for batch in batches:
            for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total = total + np.frombuffer(zlib.decompress(part), np.uint32).astype(np.uint64)
        columns = [pa.array([chunk], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "counts"])

    schema = f"doc_id {id_type}, n_shingles bigint, key binary, chunk int, counts binary"
    rows = staged(texts.mapInArrow(scan, schema), "shingle-sets")
    sums = rows.where("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    counts = np.zeros((CHUNKS, (1 << BUCKET_BITS) // CHUNKS), np.uint64)
    # As many rows as there are chunks, whatever the input.
    for row in sums.collect():
        counts[row.chunk] = np.frombuffer(zlib.decompress(bytes(row.counts)), np.uint64)
    counts = counts.reshape(-1)
    mean = counts.mean()
    level = np.where(counts > mean + 6 * math.sqrt(mean) + ROOMY, np.log2(np.maximum(counts, 1)), 0).astype(np.uint8)
    return rows.where("chunk IS NULL").select("doc_id", "n_shingles", "key"), level


def short_lists(texts: DataFrame, level: np.ndarray) -> DataFrame:
    """``token, salt, code``: the inverted lists of every set's short side, once per task and class.

    Shingles are ordered by level, then by hash. Lists of crowded buckets are salted, so that none meets whole in one task.
    """
    shared = texts.sparkSession.sparkContext.broadcast(zlib.compress(level.tobytes(), 1))

    def scan(batches):
        levels = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        seen = set()
        for batch in batches:
            tokens, salts, codes = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text)
                if not len(values):
                    continue
                key = class_key(values)
                if key in seen:
                    continue
                seen.add(key)
                own = levels[(values >> np.uint64(63 - BUCKET_BITS)).astype(np.int64)]
                if own.any():
                    order = np.argsort(own, kind="stable")
                    values, own = values[order], own[order]
                short = prefix_length(len(values))
                code = short_code(key)
                tokens.append(values[:short])
                salts.append(np.where(own[:short] > 0, code % SALTS, -1).astype(np.int8))
                codes.append(np.full(short, code, np.int64))
            if tokens:
                columns = [pa.array(np.concatenate(x)) for x in (tokens, salts, codes)]
                columns[0] = columns[0].cast(pa.int64())
                yield pa.RecordBatch.from_arrays(columns, names=["token", "salt", "code"])

    return texts.select("text").mapInArrow(scan, "token bigint, salt tinyint, code bigint")


def candidate_edges(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """``u, v``: the candidate graph over class codes, and over long lists, named by their token.

    Two names may be equal by chance; that only makes a block larger.
    """
    # Equal classes of several tasks are one entry; a list of one class leads nowhere. One shuffle serves both.
    counted = lists.repartition("token", "salt").distinct().withColumn("df", F.expr("count(1) OVER (PARTITION BY token, salt)")).where("df > 1 OR salt >= 0")
    entries = staged(counted.join(classes.select("code", "n"), "code").select("token", "salt", "code", "n"), "short-lists")
    long_entries = entries.where("salt >= 0")
    long_side = long_entries.groupBy("code").agg(F.count("*").alias("long"))
    # The set whose short side ends first has all its matches there, in merged or in long lists.
    beyond = F.col("n") - F.floor((100 - PERCENT) * F.col("n") / 100) - 1
    merged = entries.where("salt < 0").join(long_side, "code", "left")
    merged = merged.select("token", "code", "n", (beyond + F.coalesce("long", F.lit(0))).alias("rest"))
    a, b = merged.alias("a"), merged.alias("b")
    close = f"a.token = b.token AND a.code < b.code AND {PERCENT} * greatest(a.n, b.n) <= 100 * least(a.n, b.n)"
    required = F.ceil(F.lit(PERCENT) * (F.col("a.n") + F.col("b.n")) / (100 + PERCENT)) - F.greatest("a.rest", "b.rest")
    pairs = a.join(b, F.expr(close)).select(F.col("a.code").alias("u"), F.col("b.code").alias("v"), required.alias("required"))
    pairs = pairs.groupBy("u", "v", "required").agg(F.count("*").alias("common")).where("common >= required").select("u", "v")
    return pairs.union(long_entries.select(F.col("code").alias("u"), (-F.col("token") - 1).alias("v")))


def divide_skip(keys: list, sets: list[np.ndarray], asks: np.ndarray, forest: Forest):
    """Links from the asking sets to the others of one block that join different parts of ``forest``.

    The lists of a query are divided: the longest L are only probed, by binary search in the candidate's set; the
    others are merged, and a class has to occur T - L times among them.
    """
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    firsts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    names = tokens[firsts]
    lengths = np.diff(np.append(firsts, len(tokens)))
    widest = math.log2(max(2, int(lengths.max())))
    for q in np.flatnonzero(asks):
        own, n = sets[q], int(sizes[q])
        at = np.searchsorted(names, own)
        by_length = np.argsort(lengths[at], kind="stable")
        least = -(-PERCENT * n // 100)
        skipped = min(least - 1, int(least / (PROBE * widest + 1)))
        short, long = at[by_length[: n - skipped]], own[np.sort(by_length[n - skipped :])]
        short = short[lengths[short] > 1]
        if not len(short):
            continue
        merged = np.concatenate([owners[f : f + k] for f, k in zip(firsts[short], lengths[short])])
        found = np.bincount(merged, minlength=len(sets))
        fits = (found >= least - skipped) & (PERCENT * np.maximum(sizes, n) <= 100 * np.minimum(sizes, n))
        fits[q] = False
        candidates = np.flatnonzero(fits)
        for c in candidates[np.argsort(-found[candidates], kind="stable")]:
            if forest.find(keys[q]) == forest.find(keys[c]):
                continue
            other = sets[c]
            place = np.searchsorted(other, long)
            place[place == len(other)] = 0
            common = int(found[c]) + int((other[place] == long).sum())
            if (100 + PERCENT) * common >= PERCENT * (n + len(other)):
                forest.union(keys[q], keys[c])
                yield keys[q], keys[c]


def search_sets(keys, payloads, asks, forest):
    """``divide_skip`` over payloads of a class key and a text; a text of another class does not count."""
    sets, names, asking = [], [], []
    for key, payload, ask in zip(keys, payloads, asks):
        values = shingles(payload[16:].decode())
        if len(values) and class_key(values) == payload[:16]:
            sets.append(values)
            names.append(key)
            asking.append(ask)
    return divide_skip(names, sets, np.array(asking), forest) if sets else ()


def links_of(texts: DataFrame, classes: DataFrame, level: np.ndarray) -> DataFrame:
    """``u, v``: links between the first ids of classes, enough of them to connect what is connected."""
    parts = components(candidate_edges(short_lists(texts, level), classes))
    blocks = parts.select(F.col("node").alias("code"), F.col("component").alias("block")).join(classes, "code")
    sizes = staged(blocks.groupBy("block").agg(F.count("*").alias("count")).where("count > 1"), "block-sizes")
    wanted = staged(blocks.join(sizes, "block").select("block", "count", F.col("key").alias("class_key"), "first"), "blocks")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    found = texts.join(wanted, texts.doc_id == wanted["first"])
    payload = F.concat("class_key", F.encode("text", "UTF-8")).alias("payload")
    members = staged(found.select("block", "count", F.col("first").alias("key"), payload), "block-texts")
    return links_in_blocks(members, search_sets, BLOCK)


def join_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest id that a chain of links leads to. Null, empty and blank texts have 0 shingles
    and are linked with nothing, not even each other. Texts of fewer than 5 words have one shingle, their whole
    sequence. Rows with equal sets are linked; repeated rows give repeated rows; classes whose smallest id is the same
    (rows of one id and different texts) count as linked. Texts of any length count whole; an
    empty table gives no rows. Other columns are not carried.
    """
    texts = documents_of(docs, id_column, text_column)
    rows, level = sets_of(texts)
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"))
    classes = staged(classes.withColumn("code", _code(F.col("key"))), "classes")
    parts = components(links_of(texts, classes, level)).select(F.col("node").alias("first"), F.col("component").alias("component_id"))
    named = classes.join(parts, "first", "left").select("key", F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(named, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _code(key):
    """``short_code`` of a column: the first 8 bytes, little-endian, as a signed number."""
    hexed = F.hex(key)
    swapped = F.concat(*(F.substring(hexed, 2 * k + 1, 2) for k in range(7, -1, -1)))
    return F.conv(swapped, 16, -10).cast("bigint")
