"""Every query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, difference
from corpusprep.plans.catalog import QUERIES

NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, data, con, name):
    df = entry_points.queries()[name](spark, data)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert name in NO_SQL
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_entry_runs_with_a_stable_schema(spark):
    df = entry_points.entry(spark)
    assert df.dtypes == [("doc_id", "bigint"), ("lemmas", "string")]
    assert df.count() == 200
