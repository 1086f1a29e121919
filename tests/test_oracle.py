"""Every registered query with a SQL counterpart gives the same rows in both engines."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare, duck


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, con, small, name):
    assert compare(spark, con, name, small).startswith("ok")


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
