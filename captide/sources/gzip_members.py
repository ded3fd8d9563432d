"""Gzip files of many members (appended streams), indexed and read by many tasks.

A file written by appending gzip streams is one logical text, but a reader that inflates it from the start
reads it in one task. Here:

1. **Candidate starts.** The file is cut into byte ranges; a task finds every place in its range where the
   gzip magic and deflate method stand (``1f 8b 08``), and tries to inflate a member from there, reading on
   past its range as far as the member goes. A candidate that inflates to its end with a good CRC and length
   gives its end offset, its inflated size and the parity of its quote characters.
2. **Chaining.** A member starts at 0 or where another member ends. Per file, the candidates are followed
   from offset 0 from end to start; candidates off the chain (magic bytes inside compressed data that
   happened to inflate) are dropped. Only ``(start, end)`` pairs meet here, never content.
3. **Parallel inflation.** Every member is then a unit of work. For CSV, a member's starting quote state comes
   from a running XOR over the members before it, and a task cuts the records that start in its member, reading
   on into the next members for a record that runs past its end, as ``split_csv`` does with byte ranges.

A file that is one member is one unit; so is a file that is not gzip at all (no chain from 0: it yields an
error). Trailing bytes after the last member that do not form a member end the read with an error.
"""

from __future__ import annotations

import csv
import io
import gzip
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from captide.sources.files import locate
from captide.sources.split_csv import record_ends

RANGE_BYTES = 32 * 1024 * 1024
_READ = 1024 * 1024
MAGIC = b"\x1f\x8b\x08"


def _open(path: str):
    filesystem, where = locate(path)
    return filesystem.open_input_file(where)


def inflate_member(f, start: int, size: int, sink=None):
    """Inflate the member at ``start``: (end offset, inflated bytes, quote parity, ends with a line break),
    or None if no whole member is there."""
    f.seek(start)
    inflater = zlib.decompressobj(31)
    position, total, parity, newline = start, 0, 0, False
    try:
        while position < size:
            chunk = f.read(min(_READ, size - position))
            if not chunk:
                break
            out = inflater.decompress(chunk)
            total += len(out)
            parity ^= out.count(b'"') & 1
            if out:
                newline = out[-1:] == b"\n"
            if sink is not None:
                sink(out)
            if inflater.eof:
                return position + len(chunk) - len(inflater.unused_data), total, parity, newline
            position += len(chunk)
    except zlib.error:
        return None
    return None


def _candidates(frames):
    for frame in frames:
        out = []
        for path, start, end, size in zip(frame["path"], frame["start"], frame["end"], frame["size"]):
            with _open(path) as f:
                f.seek(int(start))
                window = f.read(int(min(end + len(MAGIC) - 1, size) - start))
                at = window.find(MAGIC)
                while 0 <= at < end - start:
                    found = inflate_member(f, int(start) + at, int(size))
                    if found is not None:
                        out.append((path, int(start) + at, *found))
                    at = window.find(MAGIC, at + 1)
        yield pd.DataFrame(out, columns=["path", "start", "end", "inflated", "parity", "newline"]).astype(
            {"start": "int64", "end": "int64", "inflated": "int64", "parity": "int32", "newline": "bool"}
        )


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    """The members on the chain from offset 0, in order."""
    found = frame.dropna(subset=["start"])
    ends = dict(zip(found["start"].astype("int64"), zip(found["end"].astype("int64"), found["inflated"], found["parity"], found["newline"])))
    path, size = frame["path"].iloc[0], int(frame["size"].iloc[0])
    out, at = [], 0
    while at < size:
        if at not in ends:
            raise ValueError(f"{path}: no gzip member starts at byte {at}")
        end, inflated, parity, newline = ends[at]
        out.append((path, len(out), at, end, inflated, parity, newline))
        at = end
    return pd.DataFrame(out, columns=["path", "member", "start", "end", "inflated", "parity", "newline"])


_CAND = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("inflated", T.LongType()),
        T.StructField("parity", T.IntegerType()),
        T.StructField("newline", T.BooleanType()),
    ]
)
_MEMBER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("member", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("inflated", T.LongType()),
        T.StructField("parity", T.IntegerType()),
        T.StructField("newline", T.BooleanType()),
    ]
)


def index_members(spark: SparkSession, path: str, pattern: str = "*.gz", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, member, start, end, inflated, parity, newline`` of every member of every gzip file; see the module text."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    n_ranges = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(range_bytes))).cast("int")
    ranges = files.where(F.col("size") > 0).select("path", "size", F.explode(F.sequence(F.lit(0), n_ranges - 1)).alias("index"))
    ranges = ranges.select(
        "path", "size", (F.col("index") * range_bytes).alias("start"), F.least("size", (F.col("index") + 1) * range_bytes).alias("end")
    )
    n = max(1, ranges.count())
    found = ranges.repartitionByRange(n, "path", "start").mapInPandas(_candidates, _CAND)
    # Every file forms a group, also one without any candidate: it is then no gzip file, which is an error.
    return files.join(found, "path", "left").groupBy("path").applyInPandas(_chain, _MEMBER)


def _member_rows(columns: list[str], mode: str, encoding: str):
    width = len(columns)

    def run(frames):
        for frame in frames:
            out = []
            for path, member, start, end, size, inside, opens in zip(
                frame["path"], frame["member"], frame["start"], frame["end"], frame["size"], frame["inside"], frame["opens"]
            ):
                data = bytearray()
                with _open(path) as f:
                    inflate_member(f, int(start), int(size), data.extend)
                    if not data:
                        continue
                    ends, state = record_ends(bytes(data), bool(inside))
                    # A record starts at the member's first byte if the text before it closed one.
                    first = 0 if opens else (ends[0] if ends and ends[0] < len(data) else None)
                    if first is None:
                        continue
                    body = bytearray(data[first:])
                    at = int(end)
                    while not (ends and ends[-1] == len(data)) and at < size:
                        # The last record runs on into the next members.
                        data = bytearray()
                        found = inflate_member(f, at, int(size), data.extend)
                        if found is None:
                            raise ValueError(f"{path}: no gzip member starts at byte {at}")
                        ends, state = record_ends(bytes(data), state)
                        if ends:
                            body += data[: ends[0]]
                            break
                        body += data
                        at = found[0]
                for k, cells in enumerate(csv.reader(io.StringIO(bytes(body).decode(encoding), newline=""), strict=False)):
                    if start == 0 and k == 0:
                        continue  # header
                    if len(cells) != width:
                        if mode == "FAILFAST":
                            raise ValueError(f"{path}: a record of {len(cells)} cells, {width} expected")
                        continue
                    out.append([c if c != "" else None for c in cells])
            yield pd.DataFrame(out, columns=columns, dtype=object)

    return run


def read_gzip_csv(
    spark: SparkSession, path: str, columns: list[str], mode: str = "FAILFAST", encoding: str = "utf-8", pattern: str = "*.gz",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Records of quoted CSV in gzip files of many members, one task a member; results as ``split_csv``."""
    if mode not in ("FAILFAST", "DROPMALFORMED"):
        raise ValueError(f"mode must be FAILFAST or DROPMALFORMED, not {mode!r}")
    # Empty members hold no byte and no record; the others follow each other directly.
    members = index_members(spark, path, pattern, range_bytes).where(F.col("inflated") > 0)
    before = Window.partitionBy("path").orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1
    previous_newline = F.lag("newline").over(Window.partitionBy("path").orderBy("member"))
    first_member = F.col("member") == F.min("member").over(Window.partitionBy("path"))
    states = members.select(
        "path", "member", "start", "end", inside.alias("inside"), (first_member | (previous_newline & ~inside)).alias("opens")
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    planned = states.join(files, "path")
    n = max(1, planned.count())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return planned.repartitionByRange(n, "path", "member").mapInPandas(_member_rows(columns, mode, encoding), schema)


def append_members(frames_of_rows, f, columns: list[str], header: bool) -> None:
    """Write CSV rows to an open binary file as one gzip member per batch (what appending does).

    Every cell is quoted; a null is written as an empty cell.
    """
    first = header
    for rows in frames_of_rows:
        text = io.StringIO()
        writer = csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_ALL)
        if first:
            writer.writerow(columns)
            first = False
        writer.writerows(rows)
        f.write(gzip.compress(text.getvalue().encode("utf-8")))


def write_gzip_members(df: DataFrame, folder: str, columns: list[str]) -> DataFrame:
    """Write ``df`` as CSV files of many gzip members: one file a partition, one member an Arrow batch.

    A task writes its file under a name given by its partition, so a task that runs again writes the same
    file anew. Returns ``path, rows`` of the files, for the caller to act on.
    """
    from pyspark import TaskContext

    def run(frames):
        context = TaskContext.get()
        name = f"{folder.rstrip('/')}/part-{context.partitionId():05d}.csv.gz"
        filesystem, where = locate(name)
        rows = 0
        with filesystem.open_output_stream(where, compression=None) as f:
            def batches():
                nonlocal rows
                for frame in frames:
                    rows += len(frame)
                    yield frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()

            append_members(batches(), f, columns, header=True)
        yield pd.DataFrame({"path": [name], "rows": [rows]})

    filesystem, where = locate(folder)
    filesystem.create_dir(where, recursive=True)
    return df.select(*columns).mapInPandas(run, "path string, rows long")
