"""Helpers of the operators: columns in a known form, staging on shared storage, worker state."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.session import staged, tune

__all__ = ["WORD_CODES", "WORD_HASHES", "documents_of", "query_registry", "staged", "table", "tune"]


# A word takes about 200 bytes of a worker's memory, and an executor has a worker per core. Up to twice as many words are held.
KEPT_WORDS = 1 << 17


class WordHashes(dict):
    """64-bit hashes of words (strings, or bytes of UTF-8): those met last, within bounds, and in use for every operator of a worker."""

    def __init__(self):
        super().__init__()
        self.before: dict[str | bytes, int] = {}

    def __missing__(self, word):
        if len(self) >= KEPT_WORDS:
            self.before = dict(self)
            self.clear()
        value = self.before.get(word)
        if value is None:
            value = int.from_bytes(hashlib.blake2b(word if isinstance(word, bytes) else word.encode(), digest_size=8).digest(), "little")
        self[word] = value
        return value


WORD_HASHES = WordHashes()

# A code takes 16 bytes of a worker's memory.
KEPT_CODES = 1 << 20


class WordCodes:
    """The hashes of ``WORD_HASHES`` for whole arrays of different words. Those met last are kept by a cheap hash of 64 bits, within bounds."""

    def __init__(self):
        self.names, self.codes = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def of(self, words: pa.LargeStringArray) -> np.ndarray:
        """The hash of each word; words may be empty, not null."""
        if not len(words):
            return np.empty(0, np.uint64)
        names = self._names(words)
        order = np.argsort(names)
        sorted_names = names[order]
        at = np.searchsorted(self.names, sorted_names)
        known = np.zeros(len(at), bool)
        inside = at < len(self.names)
        known[inside] = self.names[at[inside]] == sorted_names[inside]
        found = np.empty(len(at), np.uint64)
        found[known] = self.codes[at[known]]
        new = words.take(pa.array(order[~known])).to_pylist()
        found[~known] = np.frombuffer(b"".join([hashlib.blake2b(w.encode(), digest_size=8).digest() for w in new]), "<u8")
        if len(self.names) + len(new) > KEPT_CODES:
            self.names, self.codes = sorted_names[:KEPT_CODES], found[:KEPT_CODES]
        else:
            self.names, self.codes = (np.insert(kept, at[~known], own[~known]) for kept, own in ((self.names, sorted_names), (self.codes, found)))
        codes = np.empty(len(at), np.uint64)
        codes[order] = found
        return codes

    @staticmethod
    def _names(words: pa.LargeStringArray) -> np.ndarray:
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        sizes = np.diff(ends)
        letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
        place = np.arange(len(letters)) - np.repeat(ends[:-1] - ends[0], sizes)
        letters = (letters + np.uint64(1)) * np.cumprod(np.full(sizes.max() + 1, 0x9E3779B97F4A7C15, np.uint64))[place]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters)))
        return sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]


WORD_CODES = WordCodes()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the key and the text, as ``doc_id`` and ``text``: other columns cannot clash with outputs."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def query_registry():
    """A dict of queries and the decorator that fills it with tuned sessions."""
    queries = {}

    def query(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        queries[function.__name__] = run
        return run

    return queries, query
