"""Every registered query with checking SQL, beside DuckDB, on the smallest data."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_as_duckdb(spark, con, key):
    assert difference(QUERIES[key](spark, FOLDER), con, ORACLE[key]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150


def test_every_key_is_registered():
    assert set(ORACLE) <= set(QUERIES)
