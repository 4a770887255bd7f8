"""Every registered query against its SQL; the others must return rows."""

import pytest

import __spark_entry__ as entry
from checks.against_oracle import connect, difference
from checks.all import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, sf, key):
    assert difference(spark, con, sf, QUERIES[key], ORACLES.get(key)) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLES.keys()


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
