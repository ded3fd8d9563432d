"""Substring dedup: word windows that already stand in an earlier document are removed.

A window is ``WINDOW`` consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged) of one document. A word goes if it
is covered by a window whose word sequence also starts in a document with a smaller ``doc_id``; windows are
judged on the input, not on what is left.

How it runs:

0. **Exact copies.** Documents with equal words (two 64-bit hashes) are grouped by an aggregate of one row per
   document; every copy after the first with at least ``WINDOW`` words is wholly covered by the first, and
   copies take no further part (the first holds all their windows under a smaller id).
1. **Reference shards.** Every window is hashed (64 bits, numpy over whole Arrow batches). A running minimum
   per hash finds the smallest document holding it; windows whose hash first stands in a smaller document
   name that document as their *source*. Sources are dealt into shards of at most ``SHARD_WORDS`` words
   by a hash of their id.
2. **Suffix automata.** A task gets one shard and the documents that need it (their candidate windows point
   there). It builds the suffix automaton of the shard's word sequences (documents kept apart by separators),
   notes for every state the smallest document in which its strings end, and streams each candidate document
   through it: the matching statistics (longest match ending at each word) show every window that stands in
   a smaller document, exactly, without trusting the hash. Maximal runs of covered words come out as spans.
   A shard needed by many documents is read by several tasks, each with a bounded share of them
   (``CANDIDATE_WORDS``), so a passage in thousands of documents does not meet in one task.
3. Spans of all shards are merged per document, and the kept words are hashed.

The automaton stays on the executors: each shard is built where it is used, never on the driver.

Defined results: a null text has no words (0, 0, hash of the empty string); a text of fewer than ``WINDOW``
words has no window and loses nothing; repeated rows with the same id and text are judged alike (neither is
smaller than the other, so copies under one id remove nothing from each other; rows that share an id but
differ in text are kept apart by a hash of id and words); a null ``doc_id`` is never
smaller than another id and never finds an earlier source (its words stay). Extra columns are not carried.
Hash collisions can only hide a source (2^-64 a pair), never remove a word: removal is proved by the automaton.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from captide.llm.common import staged
from captide.session import broadcast_if_small

WINDOW = 13
SHARD_WORDS = 400_000
CANDIDATE_WORDS = 2_000_000

SEPARATOR = r"[\x20\x09-\x0D]+"
UNKNOWN = -(2**62)
# So many words are hashed at once.
PORTION = 1 << 16
_BYTES = np.random.default_rng(13).integers(0, 1 << 64, 256, np.uint64)

_SPAN = T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])
_SPANS = T.StructType([T.StructField("row", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN))])


def words_of(text: F.Column) -> F.Column:
    """The words of a text, in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR), "")


class SuffixAutomaton:
    """Suffix automaton of integer sequences; every state knows the smallest document its strings end in."""

    def __init__(self):
        self.next = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [np.iinfo(np.int64).max]
        self.last = 0

    def extend(self, symbol: int, doc: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[self.last] + 1)
        first.append(doc)
        p = self.last
        while p != -1 and symbol not in nxt[p]:
            nxt[p][symbol] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][symbol]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                first.append(np.iinfo(np.int64).max)
                while p != -1 and nxt[p].get(symbol) == q:
                    nxt[p][symbol] = clone
                    p = link[p]
                link[q] = clone
                link[cur] = clone
        self.last = cur

    def finish(self, window: int) -> list[int]:
        """The smallest document of the state holding each state's suffix of ``window`` symbols."""
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        first = self.first
        for state in reversed(order):
            parent = self.link[state]
            if parent >= 0 and first[state] < first[parent]:
                first[parent] = first[state]
        holder = list(range(len(order)))
        for state in order:
            parent = self.link[state]
            if parent >= 0 and self.length[parent] >= window:
                holder[state] = holder[parent]
        return [first[holder[s]] for s in range(len(order))]


def covered_spans(automaton: SuffixAutomaton, smallest: list[int], ids: list[int], doc: int, window: int) -> list[tuple[int, int]]:
    """Maximal runs of words of ``ids`` covered by windows that stand in a document smaller than ``doc``."""
    nxt, link, length = automaton.next, automaton.link, automaton.length
    spans: list[tuple[int, int]] = []
    state, matched = 0, 0
    for end, symbol in enumerate(ids):
        while state and symbol not in nxt[state]:
            state = link[state]
            matched = length[state]
        if symbol in nxt[state]:
            state = nxt[state][symbol]
            matched += 1
        else:
            state, matched = 0, 0
        if matched >= window and smallest[state] < doc:
            start = end - window + 1
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], end + 1)
            else:
                spans.append((start, end + 1))
    return spans


def _match_shard(key, refs: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
    """Build the shard's automaton from ``refs`` and find the covered spans of every candidate."""
    if cands.empty or refs.empty:
        return pd.DataFrame({"row": pd.Series([], dtype="int64"), "spans": pd.Series([], dtype=object)})
    codes: dict[str, int] = {}
    automaton = SuffixAutomaton()
    refs = refs.sort_values("doc_id", kind="stable")
    for separator, (doc, words) in enumerate(zip(refs["doc_id"], refs["words"])):
        for word in words:
            automaton.extend(codes.setdefault(word, len(codes)), int(doc))
        automaton.extend(-1 - separator, int(doc))
    smallest = automaton.finish(WINDOW)
    out_ids, out_spans = [], []
    for doc, row, words in zip(cands["doc_id"], cands["row"], cands["words"]):
        # A word that is not in the shard gets a code that no transition has.
        ids = [codes.get(w, UNKNOWN) for w in words]
        spans = covered_spans(automaton, smallest, ids, int(doc), WINDOW)
        if spans:
            out_ids.append(int(row))
            out_spans.append([{"s": s, "e": e} for s, e in spans])
    return pd.DataFrame({"row": pd.Series(out_ids, dtype="int64"), "spans": pd.Series(out_spans, dtype=object)})


def _kept(frame_iter):
    for frame in frame_iter:
        n_removed, hashes = [], []
        for words, spans in zip(frame["words"], frame["spans"]):
            words = list(words) if words is not None else []
            keep = np.ones(len(words), dtype=bool)
            for span in spans if spans is not None else []:
                keep[span["s"] : span["e"]] = False
            kept = [w for w, k in zip(words, keep) if k]
            n_removed.append(int(len(words) - keep.sum()))
            hashes.append(hashlib.sha256(" ".join(kept).encode("utf-8")).hexdigest())
        yield pd.DataFrame(
            {
                "doc_id": frame["doc_id"],
                "n_words": frame["n_words"].astype("int64"),
                "n_removed": pd.Series(n_removed, dtype="int64"),
                "kept_sha256": pd.Series(hashes, dtype=object),
            }
        )


_RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: its bytes by a table, times the powers of an odd number by place."""
    text = b" ".join(words) + b" "
    if len(text) > 64 * PORTION:
        # Very long words are told apart by a digest, so that what numpy holds stays bounded.
        words = [w if len(w) <= 1024 else b"\0" + hashlib.sha256(w).hexdigest().encode() for w in words]
        text = b" ".join(words) + b" "
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    places = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    powers = np.cumprod(np.full(int(places.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return _mixed(np.add.reduceat(_BYTES[data] * powers[places], starts))


def window_hashes(texts):
    """Yields ``(owners, hashes)``: the hash of every window, with the number of its text, for portions of the texts."""

    def portion():
        words = word_hashes(held)
        hashes = np.zeros(len(words) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(hashes)]
        owner = np.repeat(owners, sizes)
        inside = owner[: len(hashes)] == owner[WINDOW - 1 :]
        return owner[: len(hashes)][inside], _mixed(hashes[inside])

    held, owners, sizes = [], [], []
    for number, text in enumerate(texts):
        words = text.split()
        # The windows that start in a slice; windows of slices side by side that cross their border are in the earlier one.
        for low in range(0, len(words) - WINDOW + 1, PORTION):
            some = words[low : low + PORTION + WINDOW - 1]
            if held and owners[-1] == number:
                yield portion()
                held, owners, sizes = [], [], []
            held += some
            owners.append(number)
            sizes.append(len(some))
            if len(held) >= PORTION:
                yield portion()
                held, owners, sizes = [], [], []
    if held:
        yield portion()


def source_pairs(docs: DataFrame) -> DataFrame:
    """``(doc_id, source)``: documents (``doc_id, text``) with a window whose hash stands first in the smaller ``source``."""

    def scan(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for owners, hashes in window_hashes(text or b"" for text in texts):
                ids = batch.column("doc_id").take(pa.array(owners))
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes.view(np.int64))], names=["doc_id", "h"])

    windows = docs.select("doc_id", "text").mapInArrow(scan, "doc_id bigint, h bigint")
    # One shuffle by hash; the smallest holder is a running minimum over the hash's rows.
    source = F.min("doc_id").over(Window.partitionBy("h"))
    return windows.select("doc_id", source.alias("source")).where(F.col("source") < F.col("doc_id")).distinct()


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_sha256``; see the module text."""
    spark = docs.sparkSession
    # Words are split again where they are needed: reading the input twice costs less disk than storing it.
    text = F.col(text_column).cast("string")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), words_of(text).alias("words"))
    texts = texts.withColumn("row", F.xxhash64("doc_id", "words"))
    n_words = F.size("words").cast("long")

    # Exact copies: a later document with the text of an earlier one (and a window at all) loses every word,
    # and leaving it out of the window pass changes no window's smallest holder. One row per document meets.
    body = F.struct(F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), "words").alias("b"))
    bodies = texts.select("doc_id", "row", n_words.alias("n"), body.alias("body"))
    firsts = bodies.groupBy("body").agg(F.min("doc_id").alias("first"))
    copies = staged(
        bodies.join(firsts, "body").where(F.col("doc_id") > F.col("first")).select("row", "n"), "substring-copies"
    )
    known, _ = broadcast_if_small(copies.select("row"))
    pairs = staged(source_pairs(texts.join(known, "row", "left_anti")), "substring-pairs")

    # Ids of sources and candidates, and the spans found, are small beside the texts: measured, they are
    # broadcast so that the texts are joined where they are read; above the bound the join shuffles.
    source_ids, _ = broadcast_if_small(staged(pairs.select(F.col("source").alias("doc_id")).distinct(), "substring-sources"))
    sources = texts.join(source_ids, "doc_id")
    source_words = sources.agg(F.coalesce(F.sum(n_words), F.lit(0))).first()[0]
    n_shards = max(1, -(-int(source_words) // SHARD_WORDS))
    shard_of = F.pmod(F.xxhash64("source"), F.lit(n_shards))

    # Candidate documents per shard; a shard needed by many documents is split into salts of bounded words.
    needs, _ = broadcast_if_small(staged(pairs.select("doc_id", shard_of.alias("shard")).distinct(), "substring-needs"))
    cands = texts.join(needs, "doc_id")
    salts = cands.groupBy("shard").agg(F.sum(n_words).alias("w")).select(
        "shard", F.greatest(F.lit(1), F.ceil(F.col("w") / CANDIDATE_WORDS)).cast("int").alias("salts")
    )
    cands = cands.join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    refs = (
        sources.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)))
        .join(salts, "shard")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    )
    spans = (
        refs.select(*(F.col(c).alias(c) for c in ("shard", "salt", "doc_id", "words")))
        .groupBy("shard", "salt")
        .cogroup(cands.select(*(F.col(c).alias(c) for c in ("shard", "salt", "doc_id", "row", "words"))).groupBy("shard", "salt"))
        .applyInPandas(_match_shard, _SPANS)
    )
    whole = copies.where(F.col("n") >= WINDOW).select("row", F.struct(F.lit(0).cast("long").alias("s"), F.col("n").alias("e")).alias("span"))
    merged = staged(
        spans.select("row", F.explode("spans").alias("span"))
        .unionByName(whole)
        .groupBy("row")
        .agg(F.collect_list("span").alias("spans")),
        "substring-spans",
    )
    merged, _ = broadcast_if_small(merged)
    joined = texts.join(merged, "row", "left").select("doc_id", "words", n_words.alias("n_words"), "spans")
    return joined.mapInPandas(_kept, _RESULT)
