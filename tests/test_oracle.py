"""Every registered query against its SQL."""

import os

import oracle
import pytest

import __spark_entry__ as entry_point
from millrace.plans.catalog import QUERIES
from millrace.plans.oracles import ORACLES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(entry_point.queries()[name](spark, FOLDER), con, entry_point.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
