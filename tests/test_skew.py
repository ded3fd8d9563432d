from collections import Counter

import pytest
from pyspark.sql import functions as F

from captide.operators import skew
from captide.operators.skew import balanced_join, heavy_keys


def joined(left, right, how):
    out = []
    for key, a in left:
        matches = [b for k, b in right if k == key and key is not None]
        if matches:
            out += [(key, a, b) for b in matches]
        elif how == "left":
            out.append((key, a, None))
    return Counter(out)


LEFT = (
    [("hot-left", n) for n in range(500)]
    + [("hot-both", n) for n in range(60)]
    + [("lonely", n) for n in range(300)]
    + [(f"k{n}", n) for n in range(40)]
    + [("hot-right", 1), (None, 2), (None, 3)]
)
RIGHT = (
    [("hot-right", n) for n in range(400)]
    + [("hot-both", n) for n in range(70)]
    + [("hot-left", 1), ("hot-left", 2), ("k1", 1), ("k2", 1), ("k2", 2), (None, 9), ("unused", 1)]
)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("heavy_rows, small", [(50, True), (50, False), (1_000_000, True)])
def test_join_is_whole_whatever_is_heavy(spark, monkeypatch, how, heavy_rows, small):
    if not small:
        monkeypatch.setattr(skew, "broadcast_if_small", lambda df: (df, False))
    left = spark.createDataFrame(LEFT, "k STRING, a INT").repartition(5)
    right = spark.createDataFrame(RIGHT, "k STRING, b INT").repartition(3)
    result = balanced_join(left, right, "k", how, heavy_rows=heavy_rows).select("k", "a", "b")
    assert Counter(tuple(row) for row in result.collect()) == joined(LEFT, RIGHT, how)


def test_unique_right_side(spark):
    right_rows = [("hot-left", 1), ("k1", 1)]
    left = spark.createDataFrame(LEFT, "k STRING, a INT")
    right = spark.createDataFrame(right_rows, "k STRING, b INT")
    result = balanced_join(left, right, "k", "left", right_is_unique=True, heavy_rows=50).select("k", "a", "b")
    assert Counter(tuple(row) for row in result.collect()) == joined(LEFT, right_rows, "left")


def test_heavy_rows_spread_over_salts(spark, plan_of):
    left = spark.createDataFrame(LEFT, "k STRING, a INT")
    right = spark.createDataFrame(RIGHT, "k STRING, b INT")
    assert set(heavy_keys(left, "k", 50)) == {"hot-left", "hot-both", "lonely"}
    result = balanced_join(left, right, "k", "inner", heavy_rows=50)
    plan = plan_of(result)
    assert "__ls" in plan and "__rs" in plan and "REPARTITION_BY_NUM" in plan
    # 800 rows of keys heavy on the left only, in tasks of about 50.
    sizes = [len(part) for part in result.filter("k = 'hot-left'").rdd.glom().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200
    assert "__ls" not in plan_of(balanced_join(left, right, "k", "inner"))


def test_heavy_keys_among_very_many(spark):
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "third").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k")
    )
    assert set(heavy_keys(rows, "k")) == {"third"}


def test_every_heavy_key_is_found(spark):
    rows = spark.range(90_000).select(F.when(F.col("id") < 60_000, F.col("id") % 600).otherwise(F.col("id")).alias("k"))
    assert heavy_keys(rows, "k", 100) == {k: 100 for k in range(600)}


def test_numeric_keys(spark):
    left = spark.createDataFrame([(7, n) for n in range(100)] + [(8, 1)], "k BIGINT, a INT")
    right = spark.createDataFrame([(7, 1), (8, 2)], "k BIGINT, b INT")
    assert balanced_join(left, right, "k", heavy_rows=10).count() == 101


def test_other_join_types_are_refused(spark):
    one = spark.createDataFrame([("a",)], "k STRING")
    with pytest.raises(ValueError):
        balanced_join(one, one, "k", "full")
