"""Run registered queries next to their SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, db, sql: str) -> str | None:
    """What differs between a query and its SQL; None if they agree."""
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    expected = comparable(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} instead of {names}"
    actual = comparable([tuple(row) for row in df.collect()], df.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    for got, wanted in zip(actual, expected):
        if got != wanted:
            return f"row {got!r:.300} instead of {wanted!r:.300}"
    return None if expected else "no rows"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name, run in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = difference(run(session, sf_dir), db, contract.oracle_sql()[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:30s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
