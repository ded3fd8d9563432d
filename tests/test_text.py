import random
import re

import pytest
from pyspark.sql import functions as F

from captide.editions import edition
from captide.functions import text
from captide.functions.identifiers import is_valid_date, member_archive_id, member_name, source_columns


def strip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v STRING").coalesce(1)
    return [r["s"] for r in df.select(text.strip_repr(F.col("v")).alias("s")).collect()]


def test_literals_of_random_texts_come_back(spark):
    choose = random.Random(3)
    alphabet = "ab '\"\\\n\r\t%+xn0é€😀\x00\x7f"
    texts = ["".join(choose.choices(alphabet, k=choose.randint(0, 30))) for _ in range(500)]
    assert strip(spark, [repr(t.encode()) for t in texts]) == texts


def test_long_literals(spark):
    texts = ["word's \"é\" \\ " * 100_000]
    assert strip(spark, [repr(t.encode()) for t in texts]) == texts


def test_other_values_are_unchanged(spark):
    values = ["bob's and 'q'", "b'open", "b'a' and 'b'", "ab'c'", "b'a'\n", "", "b", "b'", "100% + b'x'", None]
    assert strip(spark, values) == values


def test_broken_escapes_leave_the_value(spark):
    assert strip(spark, [r"b'\xzz'", "b''"]) == [r"b'\xzz'", ""]


@pytest.mark.parametrize("value", ["bob's and 'q'", "b'he\rllo'", "b'a'\nb'b'", 'b"x" y', "plain", "b'a\\n'"])
@pytest.mark.parametrize("name, pattern", [("2022", "b['\"](.*)['\"]"), ("2023", "b'(.*)'")])
def test_compatible_form(spark, value, name, pattern):
    df = spark.createDataFrame([(value,)], "v STRING")
    got = df.select(text.strip_repr_compat(F.col("v"), edition(name).repr_pattern)).first()[0]
    assert got == re.sub(pattern, "\\1", value)


def test_only_string_columns_are_cleaned(spark):
    df = spark.createDataFrame([("b'x'", 5, None, "b'y'")], "a STRING, n INT, z STRING, `x-y` STRING")
    assert tuple(text.strip_repr_columns(df).first()) == ("x", 5, None, "y")
    assert tuple(text.strip_repr_columns(df, edition("2023").repr_pattern).first()) == ("x", 5, None, "y")


def test_keyword_position(spark):
    df = spark.createDataFrame([("a clap",), ("none",), (None,)], "v STRING").coalesce(1)
    assert [r[0] for r in df.select(text.keyword_position(F.col("v"), "clap")).collect()] == [2, -1, None]


@pytest.mark.parametrize(
    "date, valid",
    [("2023-02-31", True), ("2023-1-5", True), ("2023-13-01", False), ("2023-01", False), ("2023-12-31-9", True)]
    + [("0-1-1", False), ("2023-0-1", False), ("2023-1-32", False), ("x-1-1", False), ("", False), (None, False)]
    + [("1_000-1-1", True), ("-5-1-1", False), ("2023-1.5-1", False), (" 2023 - 1 - 1 ", True)],
)
def test_valid_dates(spark, date, valid):
    assert spark.createDataFrame([(date,)], "d STRING").select(is_valid_date(F.col("d"))).first()[0] is valid


def test_source_columns(spark):
    columns = source_columns(F.lit("X_1"), compressed=False, host="http://host")
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    assert row.asDict() == {
        "download_url": "http://host/download/X_1",
        "details_url": "http://host/details/X_1",
        "meta_url": "http://host/download/X_1/X_1_meta.xml",
        "meta_file": "X_1_meta.xml",
        "page_file": "X_1.html",
    }


@pytest.mark.parametrize(
    "name, member",
    [("2014", "html/X.html.gz"), ("2017", "html/X.html.gz"), ("2022", "html/X.html"), ("2023", "html-2023/X.html")],
)
def test_member_names(spark, name, member):
    settings = edition(name)
    row = spark.range(1).select(
        member_name(F.lit("X"), settings), member_archive_id(F.lit(member), settings), member_archive_id(F.lit("X"), settings)
    )
    assert tuple(row.first()) == (member, "X", None)
    with pytest.raises(ValueError):
        edition("1999")
