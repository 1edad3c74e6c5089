"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from check_oracle import connect, difference

from tidemark.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_rows(spark, con, key):
    assert difference(QUERIES[key](spark, SF_DIR), con, ORACLE[key]) is None


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 45
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
