"""Every registered query against the same result computed by DuckDB from the raw tables."""

import pytest

import __spark_entry__ as entry_module
from sluice_checks import oracles
from sluice_checks import queries as library

from .compare import database, oracle_rows, spark_rows

QUERIES = library.registered()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, sf_dir, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = oracle_rows(db, ORACLES[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows, "the query should find something"


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0

