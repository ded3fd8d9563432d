import hashlib
import itertools
import random
import zlib

import pytest

from captide.llm import conversation_repair as R

STATES = R.STEP


def brute_force(rows):
    """Cheapest repair of already damaged rows [(role, text)], by trying every edit sequence."""
    faults = []
    seen = set()
    for role, text in rows:
        if not any(c not in " \t\n\x0b\x0c\r" for c in text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            stripped = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("truncated" if stripped[-1] not in ".!?" else None)
        seen.add((role, text))
    best = None
    options = []
    for (role, text), fault in zip(rows, faults):
        edits = [("D", None)] if fault in ("blank", "duplicate") else [("D", None), ("K", role), ("R", "user"), ("R", "assistant")]
        options.append(edits)
    gaps = [[""], ["I"], ["II"]]
    for choice in itertools.product(*options):
        for inserts in itertools.product(*([g for g in gaps] for _ in range(len(rows) + 1))):
            # Inserted rows take whatever role the pattern needs; so only their count and place matter.
            audit, lines, cost = "", [], 0
            for k in range(len(rows) + 1):
                audit += inserts[k][0]
                lines += [None] * len(inserts[k][0])
                cost += R.INSERT * len(inserts[k][0])
                if k == len(rows):
                    break
                edit, role = choice[k]
                audit += edit
                if edit == "D":
                    cost += R.DELETE
                    continue
                cost += (R.REROLE if edit == "R" else 0) + (R.TRUNCATED if faults[k] == "truncated" else 0)
                lines.append((edit, role, rows[k][1]))
            # Roles: inserted lines fill the pattern; kept and rerolled ones must fit it.
            initials = []
            state, ok, out = R.START, True, []
            for line in lines:
                if line is None:
                    role = "assistant" if state == R.AFTER_U else "user"
                    text = ""
                else:
                    edit, role, text = line
                state2 = STATES.get((state, role[:1]))
                if state2 is None:
                    ok = False
                    break
                state = state2
                out.append(f"{role}:{text}")
            if not ok or state not in R.ACCEPT:
                continue
            key = (cost, audit)
            if best is None or key < best[0]:
                best = (key, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return best


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows, expected = [], {}
    texts = ["Hello there.", "what now", "  ", "", "Fine!", "ok?", "no end"]
    for conv in range(12):
        n = rnd.randint(0, 4)
        for turn in range(n):
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "tool", None]), rnd.choice(texts + [None])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in R.repair(df).collect()}
    damaged = {r["conv_id"]: [] for r in R.damaged_rows(df).collect()}
    for r in sorted(R.damaged_rows(df).collect(), key=lambda r: (r["conv_id"], r["pos"])):
        damaged[r["conv_id"]].append((r["role"], r["text"]))
    for conv, conv_rows in damaged.items():
        (cost, audit), digest = brute_force(conv_rows)
        assert (got[conv]["cost"], got[conv]["audit"], got[conv]["repaired_sha256"]) == (cost, audit, digest), conv_rows
    assert set(got) == {r[0] for r in rows}


def test_damage_follows_the_checksum(spark):
    rows = [(7, t, "user", "Hi there.") for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = R.damaged_rows(df).collect()
    codes = {t: zlib.crc32(f"7:{t}".encode()) % 20 for t in range(40)}
    assert len(got) == sum(0 if c == 0 else 2 if c == 3 else 1 for c in codes.values())
    for r in got:
        c = codes[r["turn"]]
        assert c != 0
        assert r["text"] == ("" if c == 1 else "Hi there" if c == 2 else "Hi there.")
        assert r["role"] == "user"


def test_edge_cases(spark):
    rows = [
        (None, None, None, None),  # null id, turn, role and text
        (1, 5, "user", "x" * 100_000),  # very long
        (1, 5, "user", "x" * 100_000),  # repeated row
        (2, 0, "user", "only.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))
    got = {r["conv_id"]: r for r in R.repair(df).collect()}
    assert set(got) == {None, 1, 2}
    empty = hashlib.sha256(b"").hexdigest()
    for r in got.values():
        assert r["cost"] >= 0 and len(r["repaired_sha256"]) == 64
    assert spark.createDataFrame([], "conv_id long, turn long, role string, text string").transform(R.repair).count() == 0
    none_left = [r for r in got.values() if r["audit"] == ""]
    assert all(r["repaired_sha256"] == empty and r["cost"] == 0 for r in none_left)


def test_grammar_matches_plain_product():
    rnd = random.Random(3)
    chunks = ["".join(rnd.choice("XsSuUaAoO") for _ in range(rnd.randint(0, 60))) for _ in range(30)]
    compressed = R.chunk_matrices(chunks)
    for chunk, m in zip(chunks, compressed):
        plain = R.identity()
        for s in chunk:
            plain = R.multiply(plain, R.SYMBOLS[s])
        assert m == plain
