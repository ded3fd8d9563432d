"""Packing token sequences by minimum bin slack.

Every document becomes its ids plus an end id. Full stretches of ``capacity`` ids are sequences of their own.
The remainders meet in a window of bounded size in the task that tokenized them. For each sequence the largest
remainder of the window is set, and a bitset dynamic programme over the counted remaining lengths finds the
multiset that comes closest to the free room; the counts are found by walking back. If no multiset fills the
room, the largest remainder left is cut to fill it. What a task has left at its end is cut into sequences whose
lengths are powers of two, so that nothing is padded.

Nothing is shuffled: a task packs what it reads, and a lost task packs the same again.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from captide.llm.common import documents_of
from captide.llm.vocab import encoder

CAPACITY = 2048
WINDOW = 4096
BATCH_PIECES = 4096


def fullest(lengths: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The multiset of lengths whose sum comes closest to ``room`` from below, as ``{length: count}``.

    ``lengths`` are ``(length, count)`` pairs, tried in the order given. Bit ``s`` of the set says that sum ``s``
    can be reached; counts are split into powers of two, and each step keeps the set before it for walking back.
    """
    within = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length, count in lengths:
        left, portion = min(count, room // length), 1
        while left > 0:
            taken = min(portion, left)
            steps.append((length, taken, reached))
            reached |= (reached << (length * taken)) & within
            left -= taken
            portion *= 2
        if reached >> room & 1:
            break
    best, chosen = reached.bit_length() - 1, {}
    for length, taken, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + taken
            best -= length * taken
    return chosen


class Window:
    """The open remainders of one task; pieces are ``(doc_id, start, ids, doc_tokens)``."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_length: dict[int, list] = defaultdict(list)
        self.pieces = 0
        self.tokens = 0

    def add(self, piece) -> None:
        length = len(piece[2]) // 4
        self.by_length[length].append(piece)
        self.pieces += 1
        self.tokens += length

    def take(self, length: int):
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[length]
        self.pieces -= 1
        self.tokens -= length
        return piece

    def fill(self) -> list:
        """One sequence of ``capacity`` ids, or of all that is left if that is less."""
        chosen = [self.take(max(self.by_length))]
        room = self.capacity - len(chosen[0][2]) // 4
        counted = [(n, len(p)) for n, p in sorted(self.by_length.items(), reverse=True) if n <= room]
        for length, count in fullest(counted, room).items():
            chosen += [self.take(length) for _ in range(count)]
            room -= length * count
        if room and self.pieces:
            # Every length left is larger than the room: a smaller one would have been taken.
            doc_id, start, ids, total = self.take(max(self.by_length))
            chosen.append((doc_id, start, ids[: 4 * room], total))
            self.add((doc_id, start + room, ids[4 * room :], total))
        return chosen


def halves(pieces: list) -> list[list]:
    """Cut one short sequence into sequences whose lengths are powers of two, largest first."""
    left = sum(len(piece[2]) // 4 for piece in pieces)
    sequences, rest = [], list(pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        own = []
        while size:
            doc_id, start, ids, total = rest.pop(0)
            n = min(size, len(ids) // 4)
            own.append((doc_id, start, ids[: 4 * n], total))
            if 4 * n < len(ids):
                rest.insert(0, (doc_id, start + n, ids[4 * n :], total))
            size -= n
        sequences.append(own)
    return sequences


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    window: int = WINDOW,
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row per piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers, ``start`` counts its document's ids
    before it, ``doc_tokens`` all ids of its document with ``end_id``. The pieces of a ``sequence_id`` lie at
    ``offset`` without gaps from 0. A null or empty text gives one piece with the end id alone; texts of any length
    are packed whole; repeated rows are packed each for itself; an empty table gives no piece. Other columns are
    not carried. A sequence id is the task's number times 2**32 plus a count, so ids are not consecutive.
    """
    texts = documents_of(docs, id_column, text_column)
    end = np.array([end_id], dtype="<u4").tobytes()
    id_type = texts.schema["doc_id"].dataType.simpleString()
    columns = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")

    def pack(batches):
        worker, open_pieces = encoder(tokenizer), Window(capacity)
        number = TaskContext.get().partitionId() << 32
        rows, kind = [], None

        def put(pieces):
            nonlocal number
            offset = 0
            for doc_id, start, ids, total in pieces:
                rows.append((doc_id, start, len(ids) // 4, ids, total, number, offset))
                offset += len(ids) // 4
            number += 1

        def batch_of():
            values = list(zip(*rows)) if rows else [()] * len(columns)
            types = (kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=list(columns))

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = worker.ids(text or "") + end
                total = len(ids) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    put([(doc_id, start, ids[4 * start : 4 * (start + capacity)], total)])
                if whole < total:
                    open_pieces.add((doc_id, whole, ids[4 * whole :], total))
                if open_pieces.pieces > window:
                    # A window of few tokens waits for more; it then holds fewer than ``capacity`` pieces.
                    while open_pieces.pieces > window // 2 and open_pieces.tokens >= capacity:
                        put(open_pieces.fill())
                if len(rows) >= BATCH_PIECES:
                    yield batch_of()
        while open_pieces.pieces:
            pieces = open_pieces.fill()
            if sum(len(piece[2]) for piece in pieces) < 4 * capacity:
                for own in halves(pieces):
                    put(own)
            else:
                put(pieces)
            if len(rows) >= BATCH_PIECES:
                yield batch_of()
        if rows:
            yield batch_of()

    schema = (
        f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return texts.mapInArrow(pack, schema)
