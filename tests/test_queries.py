"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

DATA = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    problem, count = compare(spark, con, DATA, queries()[name], SQL[name])
    assert problem is None and count > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())
