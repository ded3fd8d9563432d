"""Quoted CSV files with line breaks inside cells, read by many tasks per file.

Spark's ``multiLine`` CSV reader gives a whole file to one task, because a line break may lie inside a quoted
cell and no task can tell where a record starts without reading everything before it. Here a file is cut into
byte ranges and read in two passes:

1. **Quote state per range.** With ``"`` as quote and as its own escape (``""``), the state at a byte is
   the parity of the quotes before it. So the function that a range applies to the state is a single bit,
   the parity of its own quotes. Every task counts the quotes of one range.
2. **Prefix.** A window per file composes the functions in range order (an exclusive running XOR), giving
   each range the state at its first byte.
3. **Exact records.** From that state a task finds the line breaks outside quotes; a record belongs to the
   range in which it starts. The task reads on past its end until the last of its records is closed, and
   parses its own records with the standard ``csv`` module. The first record of a file is the header.

Result rows equal those of ``spark.read.csv(multiLine=True, escape='"')`` for files written that way: every
column a string, empty cells NULL, quoted or not. A record with more or fewer cells than columns ends the read
(``mode="FAILFAST"``) or is left out (``"DROPMALFORMED"``). Gzip files are not range-readable; give them to
``read_corpus``. An empty file yields no rows; a file with only a header yields none either.
"""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import is_remote
from pyspark.sql.window import Window

from captide.sources.files import block_order, locate

RANGE_BYTES = 32 * 1024 * 1024
TASKS_PER_CORE = 3
_READ_AHEAD = 1024 * 1024
QUOTE, NEWLINE = ord('"'), ord("\n")


def _open(path: str):
    filesystem, where = locate(path)
    return filesystem.open_input_file(where)


def _parities(frames):
    """Pass 1: the parity of the quotes of each range."""
    for frame in frames:
        out = []
        for path, start, end in zip(frame["path"], frame["start"], frame["end"]):
            with _open(path) as f:
                f.seek(int(start))
                out.append(f.read(int(end - start)).count(b'"') & 1)
        yield pd.DataFrame({"path": frame["path"], "index": frame["index"], "parity": pd.Series(out, dtype="int32")})


def record_ends(data: bytes, inside: bool) -> tuple[list[int], bool]:
    """Positions just after each line break outside quotes, and the quote state at the end of ``data``."""
    ends = []
    position = 0
    while True:
        if inside:
            q = data.find(b'"', position)
            if q < 0:
                return ends, True
            position, inside = q + 1, False
            continue
        q = data.find(b'"', position)
        n = data.find(b"\n", position)
        if n >= 0 and (q < 0 or n < q):
            ends.append(n + 1)
            position = n + 1
        elif q >= 0:
            position, inside = q + 1, True
        else:
            return ends, False


def own_records(f, start: int, end: int, size: int, inside: bool) -> bytes:
    """The bytes of the records that start in ``[start, end)`` of an open file, whole."""
    f.seek(start)
    data = f.read(end - start)
    ends, state = record_ends(data, inside)
    if start == 0:
        first = 0
    else:
        # A record starts here only if the byte before the range ends a record.
        f.seek(start - 1)
        before = f.read(1)
        first = 0 if before == b"\n" and not inside else (ends[0] if ends else None)
    if first is None:
        return b""  # no record starts in this range
    if ends and ends[-1] == len(data):
        return data[first:]
    # The last record reaches past the range: read on until a line break outside quotes.
    tail = []
    position = end
    f.seek(end)
    while position < size:
        chunk = f.read(min(_READ_AHEAD, size - position))
        if not chunk:
            break
        chunk_ends, state = record_ends(chunk, state)
        if chunk_ends:
            tail.append(chunk[: chunk_ends[0]])
            break
        tail.append(chunk)
        position += len(chunk)
    return data[first:] + b"".join(tail)


def _rows(columns: list[str], mode: str, encoding: str):
    width = len(columns)

    def run(frames):
        for frame in frames:
            for path, start, end, size, inside in zip(frame["path"], frame["start"], frame["end"], frame["size"], frame["inside"]):
                out = []
                with _open(path) as f:
                    data = own_records(f, int(start), int(end), int(size), bool(inside))
                records = csv.reader(io.StringIO(data.decode(encoding), newline=""), doublequote=True, strict=False)
                for k, cells in enumerate(records):
                    if start == 0 and k == 0:
                        continue  # header
                    if len(cells) != width:
                        if mode == "FAILFAST":
                            raise ValueError(f"{path}: a record of {len(cells)} cells, {width} expected")
                        continue
                    out.append([c if c != "" else None for c in cells])
                yield pd.DataFrame(out, columns=columns, dtype=object)

    return run


def read_split_csv(
    spark: SparkSession,
    path: str,
    columns: list[str],
    range_bytes: int = RANGE_BYTES,
    mode: str = "FAILFAST",
    encoding: str = "utf-8",
    pattern: str = "*.csv",
) -> DataFrame:
    """The records of every plain CSV file under ``path``, read by ranges of ``range_bytes``; see the module text."""
    if mode not in ("FAILFAST", "DROPMALFORMED"):
        raise ValueError(f"mode must be FAILFAST or DROPMALFORMED, not {mode!r}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    n_ranges = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(range_bytes))).cast("int")
    ranges = files.where(F.col("size") > 0).select(
        "path", "size", F.explode(F.sequence(F.lit(0), n_ranges - 1)).alias("index")
    ).select(
        "path",
        "size",
        "index",
        (F.col("index") * range_bytes).alias("start"),
        F.least(F.col("size"), (F.col("index") + 1) * range_bytes).alias("end"),
    )
    # A range is the bounded unit of work; a task takes ranges of RANGE_BYTES together, one after the other, so
    # small ranges do not cost a task each. Small inputs are dealt to a few tasks a core. The rows are tiny, so
    # only an explicit count keeps adaptive execution from folding all ranges into one task.
    count, total = ranges.agg(F.count("*"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()
    few = int(spark.conf.get("spark.sql.shuffle.partitions")) if is_remote() else TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    n = max(1, min(count, max(few, -(-total // RANGE_BYTES))))
    ranges = ranges.repartitionByRange(n, "path", "index")
    parity_schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("index", T.IntegerType()), T.StructField("parity", T.IntegerType())])
    parities = ranges.select("path", "index", "start", "end").mapInPandas(_parities, parity_schema)
    before = Window.partitionBy("path").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    states = parities.select("path", "index", (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    planned = ranges.join(states, ["path", "index"]).repartitionByRange(n, block_order(F.col("path"), F.col("index")))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return planned.select("path", "start", "end", "size", "inside").mapInPandas(_rows(columns, mode, encoding), schema)
