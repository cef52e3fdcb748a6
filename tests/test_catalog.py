"""Every registered query against its DuckDB statement on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.oracle import compare, duck

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problems, _, _ = compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert not problems


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
