from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from captide.editions import edition
from captide.operators import commercials as cut

SEGMENTS = "array<struct<pos:int,start_ms:bigint,end_ms:bigint,text:string>>"


def brute_force(segments, intervals):
    return [s for s in segments if not any(a <= s[1] <= b or a <= s[2] <= b for a, b in intervals)]


def cut_rows(spark, rows):
    df = spark.createDataFrame(rows, f"archive_id STRING, segments {SEGMENTS}, intervals ARRAY<ARRAY<DOUBLE>>")
    done = cut.cut_segments(cut.sound_intervals(df))
    return {r["archive_id"]: ([tuple(s) for s in r["kept"]], r["cut_error"]) for r in done.collect()}


def test_ends_decide_and_count(spark):
    spans = {"before": (0, 5), "to": (5, 10), "in": (15, 16), "from": (20, 30), "around": (9, 21)}
    rows = [(name, [(0, a, b, "t")], [[10.0, 20.0]]) for name, (a, b) in spans.items()]
    kept = {name for name, (segments, _) in cut_rows(spark, rows).items() if segments}
    assert kept == {"before", "around"}


def test_no_intervals_keep_everything(spark):
    assert cut_rows(spark, [("s", [(0, 0, 1, "t")], [])]) == {"s": ([(0, 0, 1, "t")], None)}


def test_faults_count_only_when_reached(spark):
    inside, outside = (0, 12, 13, "t"), (1, 50, 60, "t")
    rows = [
        ("reached", [outside], [[10.0, 20.0], [1.0]]),
        ("not reached", [inside], [[10.0, 20.0], [1.0]]),
        ("broken first", [inside], [[1.0], [10.0, 20.0]]),
        ("null record", [inside], None),
        ("null record, nothing timed", [], None),
        ("no text, cut", [(0, 12, 13, None)], [[10.0, 20.0]]),
        ("no text, kept", [(0, 50, 60, None)], [[10.0, 20.0]]),
        ("null bound", [outside], [[None, 20.0]]),
        ("three bounds", [outside], [[1.0, 2.0, 3.0]]),
        ("open, not reached", [outside], [[1e9, None]]),
        ("open, reached", [outside], [[55.0, None]]),
        ("open, cut before", [inside], [[10.0, 20.0], [1.0, None]]),
        ("open, cut behind", [inside], [[1.0, None], [10.0, 20.0]]),
    ]
    errors = {name: error for name, (_, error) in cut_rows(spark, rows).items()}
    pair, text = "interval is not a pair", "segment without snippet"
    assert errors == {
        "reached": pair,
        "not reached": None,
        "broken first": pair,
        "null record": pair,
        "null record, nothing timed": None,
        "no text, cut": None,
        "no text, kept": text,
        "null bound": pair,
        "three bounds": pair,
        "open, not reached": None,
        "open, reached": pair,
        "open, cut before": None,
        "open, cut behind": pair,
    }


times = st.integers(0, 40)
shows_strategy = st.lists(
    st.tuples(
        st.lists(st.tuples(times, times), max_size=6),
        st.lists(st.tuples(times, times), max_size=4),
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(shows_strategy)
def test_array_form_equals_exploded_form_and_brute_force(spark, shows):
    rows = [
        (
            f"s{n}",
            [(pos, a, b, f"{pos};") for pos, (a, b) in enumerate(segments)],
            [[float(a), float(b)] for a, b in intervals],
        )
        for n, (segments, intervals) in enumerate(shows)
    ]
    expected = {name: brute_force(segments, intervals) for name, segments, intervals in rows}
    assert {name: kept for name, (kept, _) in cut_rows(spark, rows).items()} == expected

    df = spark.createDataFrame(rows, f"archive_id STRING, segments {SEGMENTS}, intervals ARRAY<ARRAY<DOUBLE>>")
    segments = df.select("archive_id", F.inline("segments"))
    pairs = df.select("archive_id", F.explode("intervals").alias("i"))
    intervals = pairs.select("archive_id", F.col("i")[0].alias("low"), F.col("i")[1].alias("high"))
    exploded = sorted(tuple(r) for r in cut.keep_segment_rows(segments, intervals).collect())
    assert exploded == sorted((name, *s) for name, kept in expected.items() for s in kept)


def page(*spans, fault=""):
    parts = [
        f'<div class="tvcol"><a href="/start/{a}/end/{b}"></a><div class="snipin nosel">{a}-{b};</div></div>'
        for a, b in spans
    ]
    return ("".join(parts) + fault).encode()


def pages_and_records(spark):
    pages = spark.createDataFrame(
        [
            ("cut", page((0, 5), (12, 13), (30, 40))),
            ("all", page((11, 12))),
            ("free", page((0, 5))),
            ("bad", page((0, 5), fault='<div class="tvcol"></div>')),
            ("twice", page((0, 5), (15, 16))),
            ("twice", page((30, 31))),
        ],
        "archive_id STRING, content BINARY",
    )
    records = spark.createDataFrame(
        [
            ("cut", [[10000.0, 20000.5]], 3),
            ("cut", [[0.0, 1e9]], 7),
            ("all", [[10000.0, 20000.0]], 1),
            ("bad", [[10000.0, 20000.0]], 2),
            ("twice", [[10000.0, 20000.0]], 4),
            ("absent", [[10000.0, 20000.0]], 5),
            (None, [[10000.0, 20000.0]], 6),
        ],
        "archive_id STRING, intervals ARRAY<ARRAY<DOUBLE>>, pos INT",
    )
    return pages, records


EXPECTED = [("all", ""), ("cut", "0-5;30-40;"), ("twice", "0-5;"), ("twice", "30-31;")]


def test_cutting_pages(spark):
    pages, records = pages_and_records(spark)
    cleaned = cut.cut_commercials(pages, records, edition("2022"))
    assert sorted(tuple(r) for r in cleaned.collect()) == EXPECTED
    faulty = cut.faulty_pages(pages, records, edition("2022"))
    assert [tuple(r) for r in faulty.collect()] == [("bad", "cut", "container without link")]


def test_cutting_pages_without_broadcast(spark, monkeypatch, plan_of):
    monkeypatch.setattr(cut, "broadcast_if_small", lambda df: (df, False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages, records = pages_and_records(spark)
        cleaned = cut.cut_commercials(pages, records, edition("2022"))
        assert sorted(tuple(r) for r in cleaned.collect()) == EXPECTED
        plan = plan_of(cleaned)
        assert plan.count("ArrowEvalPython") == 1
        # Pages are parsed below the join, so that segments move and not pages.
        assert plan.index("SortMergeJoin") < plan.index("ArrowEvalPython")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_are_parsed_once_and_after_the_join(spark, plan_of):
    pages, records = pages_and_records(spark)
    plan = plan_of(cut.cut_commercials(pages, records, edition("2022")))
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("BroadcastHashJoin")


def test_first_record_by_position(spark):
    _, records = pages_and_records(spark)
    first = {r["archive_id"]: r["intervals"] for r in cut.first_records(records).collect()}
    assert first["cut"] == [[10000.0, 20000.5]] and len(first) == 6


def test_semi_joins(spark):
    pages, records = pages_and_records(spark)
    listing = spark.createDataFrame([("cut",), ("all",), ("cut",)], "archive_id STRING")
    assert sorted(r["archive_id"] for r in cut.records_in_edition(records, listing).collect()) == ["all", "cut", "cut"]
    assert sorted(r["archive_id"] for r in cut.shows_with_records(pages, records).collect()) == [
        "all", "bad", "cut", "twice", "twice",
    ]


def test_sweep_cut_equals_the_join(spark):
    import random

    from captide.operators import commercials as C

    rnd = random.Random(7)
    segments, intervals = [], []
    for show in ("a", "b", "c", None):
        for k in range(60):
            start = rnd.choice([None, rnd.randint(0, 100)])
            end = None if start is None and rnd.random() < 0.5 else (start or 0) + rnd.randint(0, 10)
            segments.append((show, k, start, end, f"t{k}"))
        for _ in range(rnd.randint(0, 8)):
            low = rnd.randint(0, 100)
            intervals.append((show, float(low), float(low + rnd.choice([0, 1, 5, 20])) if rnd.random() > 0.1 else None))
    seg = spark.createDataFrame(segments, "archive_id string, pos long, start_ms long, end_ms long, text string")
    ivl = spark.createDataFrame(intervals, "archive_id string, low double, high double")
    joined = sorted(map(tuple, C.keep_segment_rows(seg, ivl).collect()), key=repr)
    swept = sorted(map(tuple, C.keep_segment_rows_by_sweep(seg, ivl).collect()), key=repr)
    assert swept == joined
