"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import __spark_entry__ as entry_points
import pytest

from tests.crosscheck import compare, connect, types_differ
from wharfline import suite

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
QUERIES, SQL = suite.QUERIES, suite.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    problem = compare(df, con, SQL[name])
    if problem == "no rows":  # too few rows at this size: an empty result shows nothing
        con, df = connect(LARGER), QUERIES[name](spark, LARGER)
        problem = compare(df, con, SQL[name])
    assert problem is None, problem
    assert not types_differ(df, con, SQL[name])


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["supplier_id", "supplier_name", "total_orders"]
    assert df.count() >= 0
