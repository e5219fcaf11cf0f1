"""Every registered query against its DuckDB twin."""

import os

import pytest

import __spark_entry__ as entry
from compare import oracle_connection, oracle_rows, spark_rows
from conftest import TESTDATA

SCALE = os.environ.get("ORACLE_SF", "sf0.01")
QUERIES = entry.core_queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(TESTDATA / SCALE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, oracle, key):
    columns, rows = spark_rows(QUERIES[key](spark, str(TESTDATA / SCALE)))
    expected_columns, expected = oracle_rows(oracle, ORACLE[key])
    assert columns == expected_columns
    assert rows == expected
    # At the smallest scale some windows hold no rows.
    assert rows or SCALE == "sf0.001"


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
