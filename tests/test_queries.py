"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from workload.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    good, note = compare(spark, con, SF_DIR, name)
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
