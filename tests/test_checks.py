"""Every registered query against its SQL, over the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, connection, name):
    assert difference(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "date"
