"""Files that hold one JSON array, read by many tasks per file.

Spark's ``multiLine`` JSON reader parses a whole file in one task. Here a file is cut into byte ranges:

1. **Automaton per range.** Outside strings, brackets change the depth; inside strings, a backslash escapes
   the next byte. A task runs its range from each of the three string states (outside, inside, inside after a
   backslash) and keeps, for each, the state at its end and the change of depth: the range's transfer
   function, three pairs.
2. **Prefix.** Per file the functions are composed in range order from (outside, depth 0): one step per
   range, and only the small tables meet.
3. **Records at depth 1.** From its entry state a task finds the separators of the array (``[``, ``,`` and
   ``]`` at depth 1 outside strings); an element belongs to the range in which its opening separator stands,
   and the task reads on past its end to close it. Elements are parsed by ``from_json``.

Elements come out with their position (file, range, order), so file order is kept. A file that is not one
array (an element outside it, or brackets that never close) yields what stands inside its array; an element
that is no JSON ends the read (``mode="FAILFAST"``) or is left out (``"DROPMALFORMED"``); fields that do not
fit the schema are null.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captide.sources.files import block_order, locate

RANGE_BYTES = 32 * 1024 * 1024
_READ = 1024 * 1024
OUT, IN, ESCAPED = 0, 1, 2
_SPECIAL = re.compile(rb'[\\"\[\]{},]')


def _open(path: str):
    filesystem, where = locate(path)
    return filesystem.open_input_file(where)


def scan(data: bytes, state: int, depth: int, on_separator=None) -> tuple[int, int]:
    """Run the automaton over ``data``; call ``on_separator(position, byte)`` for ``[ , ]`` at depth 1."""
    if not data:
        return state, depth
    position, escape_at = 0, -2
    if state == ESCAPED:
        state, position = IN, 1
    for match in _SPECIAL.finditer(data, position):
        at, byte = match.start(), match.group()
        if state == ESCAPED:
            state = IN
            if at == escape_at + 1:
                continue  # this byte is the escaped one
        if state == IN:
            if byte == b"\\":
                state, escape_at = ESCAPED, at
            elif byte == b'"':
                state = OUT
            continue
        if byte == b'"':
            state = IN
        elif byte in (b"[", b"{"):
            depth += 1
            if depth == 1 and byte == b"[" and on_separator is not None:
                on_separator(at, byte)
        elif byte in (b"]", b"}"):
            if depth == 1 and byte == b"]" and on_separator is not None:
                on_separator(at, byte)
            depth -= 1
        elif byte == b"," and depth == 1 and on_separator is not None:
            on_separator(at, byte)
    if state == ESCAPED and escape_at != len(data) - 1:
        state = IN
    return state, depth


def _transfers(frames):
    for frame in frames:
        rows = []
        for path, index, start, end in zip(frame["path"], frame["index"], frame["start"], frame["end"]):
            with _open(path) as f:
                f.seek(int(start))
                data = f.read(int(end - start))
            row = [path, int(index)]
            for state in (OUT, IN, ESCAPED):
                exit_state, delta = scan(data, state, 0)
                row += [exit_state, delta]
            rows.append(row)
        columns = ["path", "index", "out_state", "out_delta", "in_state", "in_delta", "esc_state", "esc_delta"]
        yield pd.DataFrame(rows, columns=columns).astype({c: "int64" for c in columns[1:]})


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("index")
    state, depth, rows = OUT, 0, []
    for _, r in frame.iterrows():
        rows.append((r["path"], int(r["index"]), state, depth))
        key = ("out", "in", "esc")[state]
        state, depth = int(r[f"{key}_state"]), depth + int(r[f"{key}_delta"])
    return pd.DataFrame(rows, columns=["path", "index", "state", "depth"]).astype({"index": "int64", "state": "int64", "depth": "int64"})


def elements_of(f, start: int, end: int, size: int, state: int, depth: int) -> list[bytes]:
    """The array elements whose opening separator (``[`` or ``,``) stands in ``[start, end)`` of an open file."""
    f.seek(start)
    data = f.read(end - start)
    marks: list[tuple[int, bytes]] = []
    state, depth = scan(data, state, depth, lambda at, byte: marks.append((at, byte)))
    opens = [at for at, byte in marks if byte != b"]"]
    if not opens:
        return []
    closes = [at for at, byte in marks if byte != b"["]
    text = data
    if not closes or closes[-1] <= opens[-1]:
        # The last element runs past the range: read on to its closing separator.
        position, found = end, []
        while position < size and not found:
            chunk = f.read(min(_READ, size - position))
            if not chunk:
                break
            state, depth = scan(chunk, state, depth, lambda at, byte: found.append(at) if byte != b"[" and not found else None)
            if found:
                closes.append(len(text) + found[0])
                text += chunk[: found[0] + 1]
            else:
                text += chunk
            position += len(chunk)
    out = []
    for at in opens:
        close = next((c for c in closes if c > at), None)
        if close is None:
            continue  # an array that never closes: its last element is not whole
        element = text[at + 1 : close].strip()
        if element:
            out.append(element)
    return out


def _elements(mode: str):
    def run(frames):
        for frame in frames:
            paths, indexes, orders, values = [], [], [], []
            for path, index, start, end, size, state, depth in zip(
                frame["path"], frame["index"], frame["start"], frame["end"], frame["size"], frame["state"], frame["depth"]
            ):
                with _open(path) as f:
                    found = elements_of(f, int(start), int(end), int(size), int(state), int(depth))
                for k, element in enumerate(found):
                    text = element.decode("utf-8", "replace")
                    try:
                        json.loads(text)
                    except ValueError:
                        if mode == "FAILFAST":
                            raise ValueError(f"{path}: malformed element {text[:80]!r}") from None
                        continue
                    paths.append(path)
                    indexes.append(int(index))
                    orders.append(k)
                    values.append(text)
            yield pd.DataFrame(
                {
                    "path": pd.Series(paths, dtype=object),
                    "index": pd.Series(indexes, dtype="int64"),
                    "order": pd.Series(orders, dtype="int64"),
                    "value": pd.Series(values, dtype=object),
                }
            )

    return run


def read_json_array(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST", range_bytes: int = RANGE_BYTES, pattern: str = "*") -> DataFrame:
    """The elements of one JSON array per file, as ``from_json(schema)`` columns and ``pos``; see the module text."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    n_ranges = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(range_bytes))).cast("int")
    ranges = files.where(F.col("size") > 0).select("path", "size", F.explode(F.sequence(F.lit(0), n_ranges - 1)).alias("index"))
    ranges = ranges.select(
        "path", "size", "index", (F.col("index") * range_bytes).alias("start"), F.least("size", (F.col("index") + 1) * range_bytes).alias("end")
    )
    n = max(1, ranges.count())
    ranges = ranges.repartitionByRange(n, "path", "index")
    transfer_schema = "path string, index long, out_state long, out_delta long, in_state long, in_delta long, esc_state long, esc_delta long"
    transfers = ranges.select("path", "index", "start", "end").mapInPandas(_transfers, transfer_schema)
    entries = transfers.groupBy("path").applyInPandas(_chain, "path string, index long, state long, depth long")
    planned = ranges.join(entries, ["path", "index"]).repartitionByRange(n, "path", "index")
    elements = planned.mapInPandas(_elements(mode), "path string, index long, order long, value string")
    parsed = elements.select(
        F.from_json("value", schema).alias("record"),
        F.struct(block_order(F.col("path"), F.col("index")).alias("block"), F.col("order").alias("row")).alias("pos"),
    )
    return parsed.select("record.*", "pos")
