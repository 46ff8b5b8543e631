"""Every registered query against its SQL, with types."""

import pytest

import __spark_entry__ as entry_points
from check_queries import compare, connect
from longrec import queries as registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, registry.QUERIES[name], registry.ORACLES.get(name)) == ""


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry_points_have_every_query():
    assert set(registry.QUERIES) <= set(entry_points.queries()) and set(registry.ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["o_custkey", "order_year"] and df.count() > 0
