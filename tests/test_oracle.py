"""Every registered query against its own SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from takerlens import catalog, oracle
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.statements())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(catalog.queries()[name](spark, FOLDER), con, oracle.statements()[name]) is None
