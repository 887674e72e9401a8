"""Every query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from hitwatch.plans import batch, oracle, streams
from tests.compare import database, difference

QUERIES = {**batch.QUERIES, **streams.QUERIES}
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def tables(small):
    return database(small)


def test_registry():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, tables, small, name):
    assert difference(QUERIES[name](spark, small), tables, SQL[name]) == ""
