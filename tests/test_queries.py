"""Every query against its SQL on the smallest driver tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compdict.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], con) == []


def test_entry(spark):
    assert entry(spark).count() > 0
