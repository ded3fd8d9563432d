import io
import json
import random

import pytest

from captide.sources import json_array


def test_every_cut_gives_the_elements():
    rnd = random.Random(0)
    for trial in range(500):
        items = [
            rnd.choice([{"a": 'x\\"]},[' * rnd.randint(0, 3), "b": [[1, 2.5]] * rnd.randint(0, 3)}, "s\\", 5, [1, [2]], "é,[]", None])
            for _ in range(rnd.randint(0, 10))
        ]
        text = json.dumps(items, indent=rnd.choice([None, 2]), ensure_ascii=rnd.random() < 0.5).encode()
        step = rnd.randint(1, 30)
        f, state, depth, got = io.BytesIO(text), json_array.OUT, 0, []
        for start in range(0, len(text), step):
            end = min(len(text), start + step)
            got += json_array.elements_of(f, start, end, len(text), state, depth)
            state, depth = json_array.scan(text[start:end], state, depth)
        assert [json.loads(g) for g in got] == items


def test_ranges_read_records_in_file_order(spark, tmp_path):
    records = [{"archive_id": f"s{i}", "intervals": [[i, i + 0.5]]} for i in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=1))
    read = json_array.read_json_array(spark, str(tmp_path), "archive_id STRING, intervals ARRAY<ARRAY<DOUBLE>>", range_bytes=100)
    rows = read.orderBy("pos").collect()
    assert [r["archive_id"] for r in rows] == [r["archive_id"] for r in records]
    assert rows[3]["intervals"] == [[3.0, 3.5]]


def test_malformed_elements(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"archive_id": "a"}, {oops}, {"archive_id": "b"}]')
    schema = "archive_id STRING"
    kept = json_array.read_json_array(spark, str(tmp_path), schema, mode="DROPMALFORMED", range_bytes=7)
    assert sorted(r["archive_id"] for r in kept.collect()) == ["a", "b"]
    with pytest.raises(Exception):
        json_array.read_json_array(spark, str(tmp_path), schema, range_bytes=7).collect()


def test_empty_array_and_empty_file(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    (tmp_path / "b.json").write_text("")
    assert json_array.read_json_array(spark, str(tmp_path), "archive_id STRING", range_bytes=1).count() == 0
