"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from tidemark.plans import oracle, registry

SF_DIR = "/root/testdata/sf0.01"
SQL = oracle.SQL


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(SQL) == set(registry.QUERIES)
    assert set(SQL) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
