"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from siltstone.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registry():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
