from pathlib import Path

import pytest

import __spark_entry__ as contract
from check_queries import connect, difference

from captide.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not found")


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    assert difference(contract.queries()[name](spark, SF_DIR), db, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["archive_id", "text_nc"]


def test_types_agree_with_sql(spark, db):
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for query in ("xml_tag_map", "timed_segments", "semi_commercial", "commercial_cut_exploded", "link_times"):
        ours = {column: names[kind] for column, kind in contract.queries()[query](spark, SF_DIR).dtypes}
        described = db.execute("DESCRIBE " + contract.oracle_sql()[query]).fetchall()
        assert ours == {row[0]: row[1] for row in described}
