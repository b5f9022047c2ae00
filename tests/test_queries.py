"""Every named query against its SQL on the smallest tables."""

import os

import pytest
from check_queries import actual, connect, difference, expected

import __spark_entry__ as entry_module
from pricewatch.bindings import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = actual(entry_module.queries()[name](spark, SF_DIR))
    assert difference(expected(con, entry_module.oracle_sql()[name]), got) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
