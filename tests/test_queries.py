"""Every registered query against its SQL, and against itself where SQL has no word for it."""

import pytest

import __spark_entry__ as entry_points
from casebook.plans import checks
from oracle import assert_same, connect

QUERIES, SQL = checks.QUERIES, checks.ORACLE_SQL


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, small, connection, name):
    assert_same(QUERIES[name](spark, small), connection, SQL[name])


def test_every_query_of_the_library_has_sql():
    assert set(checks.QUERIES) == set(checks.ORACLE_SQL)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 7
