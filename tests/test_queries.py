"""Every registered query against its SQL in DuckDB on the smallest tables."""

import pytest

from driver_queries import QUERIES, SQL
from tests.compare import connect, difference, spark_table, sql_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    got = spark_table(QUERIES[name](spark, SMALL))
    assert difference(got, sql_table(con, SQL[name])) is None


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
