"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as contract

FOLDER = os.environ.get("SHELFCAST_TEST_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_entry(spark):
    assert contract.entry(spark).count() == 10
