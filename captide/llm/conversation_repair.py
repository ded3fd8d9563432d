"""Conversation structure repair by a grammar-compressed dynamic programme.

Input rows ``conv_id, turn, role, text``. A null role or text counts as one space. Damage first, by
``crc32("conv_id:turn") % 20`` (a null id or turn written as one space): 0 drops the row, 1 empties its text,
2 removes its ``.``, ``!`` and ``?``, 3 repeats it right after itself (same turn), 4 sets its role to ``user``.
A conversation's rows are then taken by turn, nulls first, ties by role and text.

Each row's first fault counts: *blank* (no character outside ``[\\x20\\x09-\\x0D]``), *duplicate* (role and text
stood on an earlier row), *truncated* (its last such character is not one of ``.!?``). The repair is the
cheapest edit sequence whose role initials read ``(s?(ua)+)?``: Keep 0, Rerole to user/assistant 2, Delete 3
(the only edit for blank and duplicate rows), Insert an empty user/assistant row 2; a truncated row that is not
deleted adds 1. Among cheapest repairs the audit (edit initials ``K R D I`` in order) that is least in ASCII wins.

How it runs:

- Damage, order, faults, gaps and illegal pairs are SQL functions and windows.
- Each row becomes a symbol (its role class and fault). A conversation's symbols are cut into chunks of
  ``CHUNK`` rows; a task compresses all its chunks together with **Re-Pair** (the most frequent adjacent pair
  becomes a rule, again and again), so one rule serves many conversations.
- Every symbol and rule has one **min-plus transfer matrix** over the four states of the role automaton; an
  entry holds the least cost from state to state and, per number of inserted rows, the least audit string.
  Rule matrices are evaluated bottom-up, once per rule; a chunk is the product of its symbols, a conversation
  the product of its chunks (associative, so chunks of one conversation need not meet before this step).
  Keeping the least audit per length keeps the product exact: equal-length strings keep their order when
  something is appended.
- The audit is spread back over the rows by SQL windows and joins; the repaired ``role:text`` lines are
  hashed per conversation.

Defined results: every original ``conv_id`` (null included) has one row; a conversation without rows after
damage has zeros, an empty audit and the SHA-256 of the empty string. Extra input columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from captide.llm.common import staged

CHUNK = 2048
MAX_ROUNDS = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
WS = r"\x20\x09-\x0D"

# States of the role automaton of (s?(ua)+)?: start, after s, after u, after a. Start and after-a accept.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPT = (START, AFTER_A)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}

# Symbols: must-delete rows, and per role class (s, u, a, other) a clean and a truncated form.
MUST_DELETE = "X"
_CLASSES = {"s": "sS", "u": "uU", "a": "aA", "o": "oO"}

def _best(entry_a, entry_b):
    """The smaller of two entries (cost, {inserts: audit}); per length the least audit."""
    if entry_a is None:
        return entry_b
    if entry_b is None or entry_a[0] < entry_b[0]:
        return entry_a
    if entry_b[0] < entry_a[0]:
        return entry_b
    merged = dict(entry_a[1])
    for n, audit in entry_b[1].items():
        if n not in merged or audit < merged[n]:
            merged[n] = audit
    return (entry_a[0], merged)


def multiply(a, b):
    """Min-plus product of two 4 x 4 matrices of entries."""
    out = [[None] * 4 for _ in range(4)]
    for x in range(4):
        for y in range(4):
            left = a[x][y]
            if left is None:
                continue
            for z in range(4):
                right = b[y][z]
                if right is None:
                    continue
                joined = {}
                for n1, s1 in left[1].items():
                    for n2, s2 in right[1].items():
                        s = s1 + s2
                        if n1 + n2 not in joined or s < joined[n1 + n2]:
                            joined[n1 + n2] = s
                out[x][z] = _best(out[x][z], (left[0] + right[0], joined))
    return out


def _insertions():
    """Closure of inserted rows: from each state the cheapest run of inserts to each state."""
    closure = [[None] * 4 for _ in range(4)]
    for x in range(4):
        closure[x][x] = (0, {0: ""})
        state, cost, audit = x, 0, ""
        for _ in range(2):
            role = "a" if state == AFTER_U else "u"
            state, cost, audit = STEP[(state, role)], cost + INSERT, audit + "I"
            closure[x][state] = _best(closure[x][state], (cost, {len(audit): audit}))
    return closure


CLOSURE = _insertions()


def symbol_matrix(symbol: str):
    """Transfer matrix of one row (its edits) followed by any inserts."""
    row = [[None] * 4 for _ in range(4)]
    for x in range(4):
        row[x][x] = (DELETE, {0: "D"})
    if symbol != MUST_DELETE:
        role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
        for x in range(4):
            if (x, role) in STEP:
                y = STEP[(x, role)]
                row[x][y] = _best(row[x][y], (KEEP + extra, {0: "K"}))
            for new in "ua":
                if (x, new) in STEP:
                    y = STEP[(x, new)]
                    row[x][y] = _best(row[x][y], (REROLE + extra, {0: "R"}))
    return multiply(row, CLOSURE)


SYMBOLS = {s: symbol_matrix(s) for s in MUST_DELETE + "".join(_CLASSES.values())}


def re_pair(sequences: list[list]) -> tuple[list[list], dict]:
    """Re-Pair over all sequences together: rules (a, b) -> new symbol, most frequent pairs first.

    A round counts all adjacent pairs and makes rules of the frequent ones (two places or more) that share no
    symbol with a more frequent pair of the same round, so that their replacements cannot overlap; rounds
    go on while such pairs exist, at most ``MAX_ROUNDS``. What is left uncompressed stays as symbols.
    """
    rules = {}
    for _ in range(MAX_ROUNDS):
        pairs = Counter()
        for seq in sequences:
            previous = None
            for i in range(len(seq) - 1):
                pair = (seq[i], seq[i + 1])
                # Overlapping runs like x x x count their pairs once every other place.
                if pair == previous:
                    previous = None
                    continue
                pairs[pair] += 1
                previous = pair
        chosen, used = {}, set()
        for pair, count in pairs.most_common():
            if count < 2:
                break
            if pair[0] in used or pair[1] in used:
                continue
            used.update(pair)
            name = ("r", len(rules))
            rules[name] = pair
            chosen[pair] = name
        if not chosen:
            break
        replaced = []
        for seq in sequences:
            out, i = [], 0
            while i < len(seq):
                if i + 1 < len(seq) and (seq[i], seq[i + 1]) in chosen:
                    out.append(chosen[(seq[i], seq[i + 1])])
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            replaced.append(out)
        sequences = replaced
    return sequences, rules


def identity():
    return [[(0, {0: ""}) if x == y else None for y in range(4)] for x in range(4)]


def chunk_matrices(chunks: list[str]) -> list:
    """Transfer matrix of every chunk of symbols, through one Re-Pair grammar shared by all of them."""
    sequences, rules = re_pair([list(c) for c in chunks])
    matrices = dict(SYMBOLS)
    for name, (a, b) in rules.items():  # rules are numbered bottom-up: children come first
        matrices[name] = multiply(matrices[a], matrices[b])
    out = []
    for seq in sequences:
        m = identity()
        for symbol in seq:
            m = multiply(m, matrices[symbol])
        out.append(m)
    return out


def _encode(m) -> str:
    return repr([[None if e is None else (e[0], sorted(e[1].items())) for e in row] for row in m])


def _decode(text: str):
    import ast

    return [[None if e is None else (e[0], dict(e[1])) for e in row] for row in ast.literal_eval(text)]


def _chunk_task(frames):
    for frame in frames:
        matrices = chunk_matrices(list(frame["symbols"]))
        yield pd.DataFrame(
            {"conv_id": frame["conv_id"], "chunk": frame["chunk"], "matrix": [_encode(m) for m in matrices]}
        )


def _solve_task(frames):
    for frame in frames:
        costs, audits = [], []
        for chunks in frame["chunks"]:
            m = CLOSURE
            for c in sorted(chunks, key=lambda c: c["chunk"]):
                m = multiply(m, _decode(c["matrix"]))
            answer = None
            for state in ACCEPT:
                answer = _best(answer, m[START][state])
            costs.append(answer[0])
            audits.append(min(answer[1].values()))
        yield pd.DataFrame({"conv_id": frame["conv_id"], "cost": pd.Series(costs, dtype="int64"), "audit": audits})


_CHUNKS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("matrix", T.StringType())])
_SOLVED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])


def damaged_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, pos`` after damage, ``pos`` from 1 in the order of the module text."""
    conv = F.col("conv_id").cast("long")
    turn = F.col("turn").cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    rows = conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(F.encode(key, "UTF-8")) % 20).alias("damage"),
    )
    rows = rows.where(F.col("damage") != 0).select(
        "conv_id",
        "turn",
        F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, F.lit(""))
        .when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    return rows.withColumn("pos", F.row_number().over(order)).drop("copy")


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    rows = staged(damaged_rows(conversations), "repair-rows")
    conv = Window.partitionBy("conv_id")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy("pos")
    initial = F.substring("role", 1, 1)
    blank = ~F.col("text").rlike(f"[^{WS}]")
    truncated = ~F.col("text").rlike(f"[.!?][{WS}]*$")
    faults = (
        rows.withColumn("dup", F.row_number().over(seen) > 1)
        .withColumn("fault", F.when(blank, "blank").when(F.col("dup"), "duplicate").when(truncated, "truncated"))
        .withColumn("pair", F.concat(initial, F.lead(initial).over(conv.orderBy("pos"))))
    )
    role_class = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit(MUST_DELETE))
        .when(F.col("fault") == "truncated", F.upper(role_class))
        .otherwise(role_class)
    )
    faults = staged(faults.withColumn("symbol", symbol), "repair-faults")

    counts = faults.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *(F.count(F.when(F.col("fault") == f, 1)).cast("long").alias(f) for f in ("blank", "duplicate", "truncated")),
        F.count(F.when(F.col("pair").isNotNull() & ~F.col("pair").isin("su", "ua", "au"), 1)).cast("long").alias("illegal"),
    )

    chunk = F.floor((F.col("pos") - 1) / CHUNK).alias("chunk")
    chunks = faults.groupBy("conv_id", chunk).agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda r: r["symbol"])).alias("symbols")
    )
    matrices = chunks.mapInPandas(_chunk_task, _CHUNKS)
    solved = staged(
        matrices.groupBy("conv_id")
        .agg(F.collect_list(F.struct("chunk", "matrix")).alias("chunks"))
        .mapInPandas(_solve_task, _SOLVED),
        "repair-solved",
    )

    # Spread the audit over the rows: the k-th edit that is not an insert belongs to the row at pos k.
    edits = solved.select("conv_id", F.posexplode(F.split(F.col("audit"), "")).alias("i", "edit")).where(F.col("edit") != "")
    by_edit = Window.partitionBy("conv_id").orderBy("i")
    edits = edits.withColumn("pos", F.sum(F.when(F.col("edit") != "I", 1).otherwise(0)).over(by_edit)).withColumn(
        "line", F.sum(F.when(F.col("edit") != "D", 1).otherwise(0)).over(by_edit) - 1
    )
    rows_at = faults.select(F.col("conv_id").alias("key"), F.col("pos").alias("at"), "role", "text")
    placed = edits.join(
        rows_at, edits["conv_id"].eqNullSafe(rows_at["key"]) & (edits["pos"] == rows_at["at"]) & (edits["edit"] != "I"), "left"
    ).select("conv_id", "i", "edit", "line", "role", "text")
    starts_s = F.max(F.when((F.col("line") == 0) & (F.col("edit") == "K") & (F.substring("role", 1, 1) == "s"), 1).otherwise(0)).over(
        Window.partitionBy("conv_id")
    )
    step = F.col("line") - F.col("s_start")
    new_role = F.when(step % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    lines = (
        placed.withColumn("s_start", starts_s)
        .where(F.col("edit") != "D")
        .select(
            "conv_id",
            "line",
            F.when(F.col("edit") == "K", F.concat("role", F.lit(":"), "text"))
            .when(F.col("edit") == "R", F.concat(new_role, F.lit(":"), "text"))
            .otherwise(F.concat(new_role, F.lit(":")))
            .alias("text"),
        )
    )
    hashed = lines.groupBy("conv_id").agg(
        F.sha2(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda r: r["text"])), 256).alias(
            "repaired_sha256"
        )
    )

    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty_hash = F.sha2(F.lit(""), 256)
    out = every
    for part in (counts, solved, hashed):
        part = part.withColumnRenamed("conv_id", "key")
        out = out.join(part, out["conv_id"].eqNullSafe(part["key"]), "left").drop("key")
    return out.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty_hash).alias("repaired_sha256"),
    )
