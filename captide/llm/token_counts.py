"""Token counts by a two-tier lookup on the map side.

Tier one is a table of the corpus' most frequent pre-tokens with their token counts. It is found by a
mergeable frequency summary of bounded size over all documents and broadcast as two flat buffers; its size
is fixed by ``FREQUENT``, whatever the corpus. Tier two is the cache of each worker, which asks the tokenizer
library for the pre-tokens it has not met. Neither tier changes a count. No occurrence of a pre-token is ever
shuffled: only the summaries are, at most ``SUMMARY`` entries of each task.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import documents_of
from captide.llm.vocab import encoder

FREQUENT = 1 << 14
SUMMARY = 1 << 14


def prune(counts: Counter, size: int) -> Counter:
    """Keep the ``size`` largest counts, each lessened by the next one (the Misra-Gries merge)."""
    if len(counts) <= size:
        return counts
    values = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    floor = int(np.partition(values, len(values) - size - 1)[len(values) - size - 1])
    return Counter({unit: n - floor for unit, n in counts.items() if n > floor})


def frequent_units(docs: DataFrame, tokenizer: str, size: int = FREQUENT) -> list[str]:
    """At most ``size`` of the most frequent pre-tokens of all texts, most frequent first.

    Each task summarises its share of all texts, and the summaries are added up.
    """

    def summarise(batches):
        counts, units = Counter(), encoder(tokenizer).units
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update(units(text))
            if len(counts) > 16 * SUMMARY:
                counts = prune(counts, SUMMARY)
        top = prune(counts, SUMMARY)
        yield pa.RecordBatch.from_pydict({"unit": pa.array(list(top), pa.string()), "n": pa.array(list(top.values()), pa.int64())})

    summaries = docs.select("text").mapInArrow(summarise, "unit string, n bigint")
    top = summaries.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(size)
    return [row.unit for row in top.collect()]


def compact(units: list[str], lengths: list[int]) -> tuple[bytes, bytes, bytes]:
    """Flat buffers of a table from units to lengths: texts, ends of the texts, lengths."""
    encoded = [unit.encode() for unit in units]
    ends = np.cumsum([len(unit) for unit in encoded], dtype=np.uint32)
    return b"".join(encoded), ends.tobytes(), np.array(lengths, dtype=np.uint32).tobytes()


def opened(table: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    """The hash table of a task, built from the flat buffers."""
    texts, ends, lengths = table[0], np.frombuffer(table[1], np.uint32), np.frombuffer(table[2], np.uint32)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    return {texts[a:b].decode(): n for a, b, n in zip(starts.tolist(), ends.tolist(), lengths.tolist())}


def count_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``.

    Counts are those of the tokenizers library without added special tokens, truncation or padding. A null or
    empty text has 0 bytes and 0 tokens; a text of any length is counted whole; repeated rows give repeated rows;
    an empty table gives none. Other columns are not carried, so none can clash.
    """
    texts = documents_of(docs, id_column, text_column)
    units = frequent_units(texts, tokenizer)
    lengths = [len(ids) // 4 for ids in map(encoder(tokenizer).ids, units)]
    shared = docs.sparkSession.sparkContext.broadcast(compact(units, lengths))

    def count(batches):
        known, worker = opened(shared.value), encoder(tokenizer)
        for batch in batches:
            values = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(text.encode()) if text else 0 for text in values], pa.int64()),
                    pa.array([worker.count(text, known) if text else 0 for text in values], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
