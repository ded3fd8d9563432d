"""The member index of uncompressed tar archives, built by many tasks per archive.

Walking a tar archive from header to header is sequential: where a header lies is known only from the one
before it. Here an archive is cut into byte ranges (multiples of 512) and indexed in three steps:

1. **Speculative headers.** A task tests every 512-byte block of its range as a header (its checksum must
   hold; an all-zero block is an end mark). From each such candidate it knows the next header's place (past
   the member's data), so the range's *transfer function* is computed at once for all candidates: from each
   one, following next-header links inside the range, where the walk leaves the range (or that it breaks or
   ends). Blocks of member data that only look like headers (a tar inside a tar) are candidates too; they are
   sorted out in step 2.
2. **Chaining over range ends.** The true walk starts at byte 0. Per archive, the transfer functions are
   followed from range to range: one step per range the walk enters, not per member, so only ``(entry, exit)``
   pairs meet, never data.
3. **Listing.** Every range with an entry point is listed from there by the standard ``tarfile`` reader,
   which skips member data and resolves long names and extended headers; a member belongs to the range in
   which its first header stands. A walk that reaches a range through an extended header lets the range
   before it list that member.

Result: ``path, name, start, size`` of every regular file (``start`` is where its data begins), equal to a
sequential walk. A pax *global* header applies only to the members listed by the same task.
"""

from __future__ import annotations

import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captide.sources.files import locate

BLOCK = 512
RANGE_BYTES = 64 * 1024 * 1024
END, BROKEN = -1, -2
_EXTENSIONS = (tarfile.GNUTYPE_LONGNAME, tarfile.GNUTYPE_LONGLINK, tarfile.XHDTYPE, tarfile.XGLTYPE, tarfile.SOLARIS_XHDTYPE)


def _open(path: str):
    filesystem, where = locate(path)
    return filesystem.open_input_file(where)


def header_links(data: bytes, base: int) -> dict[int, tuple[int, bool]]:
    """Candidate headers of ``data`` (at ``base``): offset -> (next header's offset or END, is an extension)."""
    links = {}
    for at in range(0, len(data) - BLOCK + 1, BLOCK):
        block = data[at : at + BLOCK]
        try:
            info = tarfile.TarInfo.frombuf(block, "utf-8", "surrogateescape")
        except tarfile.EOFHeaderError:
            links[base + at] = (END, False)
            continue
        except (tarfile.HeaderError, ValueError):
            continue
        size = 0 if info.type in (tarfile.LNKTYPE, tarfile.SYMTYPE, tarfile.DIRTYPE, tarfile.CHRTYPE, tarfile.BLKTYPE, tarfile.FIFOTYPE) else info.size
        links[base + at] = (base + at + BLOCK + -(-size // BLOCK) * BLOCK, info.type in _EXTENSIONS)
    return links


def transfer(links: dict[int, tuple[int, bool]], end: int) -> dict[int, tuple[int, bool]]:
    """From every candidate: the first offset at or past ``end`` that the walk reaches (or END / BROKEN),
    and whether the step that left the range came from an extension header."""
    out: dict[int, tuple[int, bool]] = {}
    for at in sorted(links, reverse=True):
        nxt, extension = links[at]
        if nxt == END:
            out[at] = (END, False)
        elif nxt >= end:
            out[at] = (nxt, extension)
        elif nxt in links:
            out[at] = out[nxt]
        else:
            out[at] = (BROKEN, False)
    return out


def _transfers(frames):
    for frame in frames:
        rows = []
        for path, start, end in zip(frame["path"], frame["start"], frame["end"]):
            with _open(path) as f:
                f.seek(int(start))
                data = f.read(int(end - start))
            for at, (exit_, extension) in transfer(header_links(data, int(start)), int(end)).items():
                if exit_ != BROKEN:
                    rows.append((path, at, exit_, extension))
        yield pd.DataFrame(rows, columns=["path", "entry", "exit", "extension"]).astype({"entry": "int64", "exit": "int64", "extension": "bool"})


def _chain(range_bytes: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        path, size = frame["path"].iloc[0], int(frame["size"].iloc[0])
        step = {int(e): (int(x), bool(k)) for e, x, k in zip(frame["entry"], frame["exit"], frame["extension"]) if e == e}
        out, at, continued = [], 0, False
        while 0 <= at < size:
            if at not in step:
                raise ValueError(f"{path}: no tar header at byte {at}")
            out.append((path, at // range_bytes, at, continued))
            at, continued = step[at]
        return pd.DataFrame(out, columns=["path", "index", "entry", "continued"])

    return run


def _list(range_bytes: int):
    def run(frames):
        for frame in frames:
            rows = []
            for path, index, entry, continued in zip(frame["path"], frame["index"], frame["entry"], frame["continued"]):
                end = (int(index) + 1) * range_bytes
                with _open(path) as f:
                    f.seek(int(entry))
                    archive = tarfile.TarFile(fileobj=f, mode="r")
                    first = True
                    for member in archive:
                        if member.offset >= end:
                            break
                        skip = first and continued
                        first = False
                        if member.isfile() and not skip:
                            rows.append((path, member.name, member.offset_data, member.size))
            yield pd.DataFrame(rows, columns=["path", "name", "start", "size"]).astype({"start": "int64", "size": "int64"})

    return run


_TRANSFER = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("entry", T.LongType()), T.StructField("exit", T.LongType()), T.StructField("extension", T.BooleanType())]
)
_ENTRY = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("index", T.LongType()), T.StructField("entry", T.LongType()), T.StructField("continued", T.BooleanType())]
)
_INDEX = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("name", T.StringType()), T.StructField("start", T.LongType()), T.StructField("size", T.LongType())]
)


def index_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, name, start, size`` of the regular files of archives given as ``path, length``; see the module text."""
    if range_bytes % BLOCK:
        raise ValueError(f"range_bytes must be a multiple of {BLOCK}")
    files = archives.select("path", F.col("length").alias("size"))
    n_ranges = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(range_bytes))).cast("int")
    ranges = files.where(F.col("size") > 0).select("path", "size", F.explode(F.sequence(F.lit(0), n_ranges - 1)).alias("index"))
    ranges = ranges.select("path", (F.col("index") * range_bytes).alias("start"), F.least("size", (F.col("index") + 1) * range_bytes).alias("end"))
    n = max(1, ranges.count())
    transfers = ranges.repartitionByRange(n, "path", "start").mapInPandas(_transfers, _TRANSFER)
    entries = files.join(transfers, "path", "left").groupBy("path").applyInPandas(_chain(range_bytes), _ENTRY)
    return entries.repartitionByRange(n, "path", "index").mapInPandas(_list(range_bytes), _INDEX)


def read_members_by_index(spark: SparkSession, index: DataFrame, tasks: int) -> DataFrame:
    """``path, name, content`` of indexed members, spread over ``tasks`` tasks by position."""

    def run(frames):
        for frame in frames:
            contents = []
            for path, start, size in zip(frame["path"], frame["start"], frame["size"]):
                with _open(path) as f:
                    f.seek(int(start))
                    contents.append(f.read(int(size)))
            yield pd.DataFrame({"path": frame["path"], "name": frame["name"], "content": contents})

    spread = index.repartitionByRange(max(1, tasks), "path", "start").sortWithinPartitions("path", "start")
    return spread.mapInPandas(run, "path string, name string, content binary")
