"""Every query with SQL is equal to DuckDB's answer on the small tables."""

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duckdb_connection():
    return duck(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, duckdb_connection, name):
    assert difference(queries()[name](spark, FOLDER), duckdb_connection, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 15
