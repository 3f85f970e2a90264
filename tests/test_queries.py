"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import check, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert check(spark, connection, name, QUERIES[name], ORACLES.get(name), FOLDER) is None


def test_entry_has_stable_schema(spark):
    assert entry.entry(spark).columns == entry.entry(spark).columns
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
