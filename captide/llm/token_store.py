"""Token ids in files of directly addressable codes.

A file holds the ids of a range of documents. An id is split into chunks of ``CHUNK_BITS`` bits, low chunk
first. Level ``k`` stores the ``k``-th chunk of the ids that have one, and a bitmap that says which of them go on
to level ``k + 1``. A rank directory with one count per ``RANK_BITS`` bits leads from a position on one level to
its position on the next, so any id is read from a few bytes on each level, without decoding a block.

Layout, all integers little-endian::

    magic "DAC1", u32 levels, u64 documents, u64 ids
    per level: u64 chunks, then chunks (u8 each), bitmap (8 chunks per byte, low bit first), directory (u64 each)
    document ids (i64 each), document ends (u64 each, counted in ids)

Files are written by the tasks that hold a range of document ids, under a temporary name and then renamed, so
a repeated task leaves one whole file.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captide.llm.common import documents_of, staged
from captide.llm.vocab import encoder
from captide.sources.files import locate

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BITS = 512
TEXT_BYTES_PER_FILE = 8 * 1024 * 1024


def encoded(ids: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray):
    """Yields the bytes of one file in order, as buffers; never holds more than one level."""
    n_levels = max(1, -(-int(ids.max()).bit_length() // CHUNK_BITS)) if len(ids) else 1
    yield MAGIC + struct.pack("<IQQ", n_levels, len(doc_ids), len(ids))
    rest = ids
    for level in range(n_levels):
        more = rest >= 1 << CHUNK_BITS
        yield struct.pack("<Q", len(rest))
        yield rest.astype(np.uint8)
        yield np.packbits(more, bitorder="little")
        # A block counts to RANK_BITS at most; the sum casts all its items to the type.
        blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint16) if len(more) else np.empty(0, np.uint16)
        yield np.concatenate(([0], np.cumsum(blocks, dtype=np.uint64)[:-1])).astype("<u8") if len(blocks) else blocks.astype("<u8")
        if level + 1 < n_levels:
            rest = rest[more]
            rest >>= CHUNK_BITS
    yield doc_ids.astype("<i8")
    yield ends.astype("<u8")


def encode(ids: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes of one file."""
    return b"".join(bytes(part) for part in encoded(ids, doc_ids, ends))


class TokenFile:
    """Random access to the ids of one file, over its bytes (or a memory map of them)."""

    def __init__(self, data):
        self.data = memoryview(data)
        if bytes(self.data[:4]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n_levels, self.n_docs, self.n_ids = struct.unpack_from("<IQQ", self.data, 4)
        at, self.levels = 24, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", self.data, at)
            chunks = np.frombuffer(self.data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(self.data, np.uint8, (n + 7) // 8, at + 8 + n)
            at += 8 + n + len(bitmap)
            directory = np.frombuffer(self.data, "<u8", -(-n // RANK_BITS), at)
            at += 8 * len(directory)
            self.levels.append((chunks, bitmap, directory))
        self.doc_ids = np.frombuffer(self.data, "<i8", self.n_docs, at)
        self.ends = np.frombuffer(self.data, "<u8", self.n_docs, at + 8 * self.n_docs)

    def token(self, position: int) -> int:
        """The id at a position: one chunk, one bit and one rank per level."""
        value, shift = 0, 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[position]) << shift
            if not bitmap[position >> 3] >> (position & 7) & 1:
                break
            block = position // RANK_BITS
            first = block * RANK_BITS
            before = np.unpackbits(bitmap[first // 8 : position // 8 + 1], bitorder="little")[: position - first]
            position = int(directory[block]) + int(before.sum())
            shift += CHUNK_BITS
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids of a range: each level gives one contiguous stretch."""
        out = np.zeros(max(0, end - start), dtype=np.uint32)
        places, shift = np.arange(len(out)), 0
        for chunks, bitmap, directory in self.levels:
            if not len(places):
                break
            out[places] |= chunks[start : start + len(places)].astype(np.uint32) << shift
            first = start // 8
            bits = np.unpackbits(bitmap[first : (start + len(places) + 7) // 8], bitorder="little")
            more = bits[start - 8 * first :][: len(places)].astype(bool)
            block = start // RANK_BITS
            before = np.unpackbits(bitmap[block * RANK_BITS // 8 : start // 8 + 1], bitorder="little")
            start = int(directory[block]) + int(before[: start - block * RANK_BITS].sum()) if block < len(directory) else 0
            places = places[more]
            shift += CHUNK_BITS
        return out


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write all documents in ascending key order; returns the manifest ``file, part, n_docs, n_ids, first``.

    ``first`` is the number of ids in the files before. A null or empty text is its end id alone; rows with equal
    keys stand next to each other in the order of their texts; rows without a key come first, under the lowest
    64-bit number; an empty table gives no file. The number of files follows the bytes of text, so that a file
    stays small enough to be read at once.
    """
    spark = docs.sparkSession
    texts = documents_of(docs, id_column, text_column).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))))
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    files = max(1, -(-size // TEXT_BYTES_PER_FILE))
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches):
        worker, held, doc_ids, ends, total = encoder(tokenizer), bytearray(), [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = worker.ids(text or "") + end
                total += len(ids) // 4
                held += ids
                doc_ids.append(doc_id)
                ends.append(total)
        if not doc_ids:
            return
        part = TaskContext.get().partitionId()
        parts = encoded(np.frombuffer(held, "<u4"), np.array(doc_ids, np.int64), np.array(ends, np.uint64))
        store, path = locate(folder)
        store.create_dir(path, recursive=True)
        name, own = f"{path}/tokens-{part:06d}.dac", f"{path}/.{part:06d}-{uuid.uuid4().hex}"
        with store.open_output_stream(own) as out:
            for some in parts:
                out.write(some)
        if not isinstance(store, fs.LocalFileSystem) and store.get_file_info(name).type != fs.FileType.NotFound:
            store.delete_file(name)
        store.move(own, name)
        row = {"file": f"tokens-{part:06d}.dac", "part": part, "n_docs": len(doc_ids), "n_ids": total}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("file", pa.string()), ("part", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ordered = texts.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = staged(ordered.mapInArrow(write, "file string, part bigint, n_docs bigint, n_ids bigint"), "token-manifest")
    # One row per file: a window over them all is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint"))


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids``: the documents of the files, with the number of ids before each in all files."""
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder)
    files = stored.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    files = files.join(F.broadcast(manifest.select("file", "first")), "file")

    def read(batches):
        for batch in batches:
            for content, first in zip(batch.column("content"), batch.column("first").to_pylist()):
                stored = TokenFile(content.as_buffer())
                ends = stored.ends.astype(np.int64)
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                for low in range(0, stored.n_docs, 1024):
                    some = slice(low, low + 1024)
                    ids = stored.tokens(int(starts[some][0]), int(ends[some][-1])).astype("<u4")
                    at = starts[some] - starts[some][0]
                    values = [ids[a : a + n].tobytes() for a, n in zip(at, ends[some] - starts[some])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(stored.doc_ids[some], pa.int64()), pa.array(starts[some] + first, pa.int64()), pa.array(values, pa.binary())],
                        names=["doc_id", "start", "ids"],
                    )

    return files.mapInArrow(read, "doc_id bigint, start bigint, ids binary")

