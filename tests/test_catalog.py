"""Every catalogue query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from plantspark.plans.catalog import QUERIES
from plantspark.plans.oracle import ORACLE as SQL
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF).toArrow()
    assert found.num_rows > 0
    assert difference(found, duck.sql(SQL[name]).to_arrow_table()) == ""
