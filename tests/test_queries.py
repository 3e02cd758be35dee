"""Every registered query against its SQL oracle, on whole tables."""

import pytest

import __spark_entry__ as entry
from corpusloom.plans import catalogue
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert not set(QUERIES) - set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(con, QUERIES[name](spark, SF), ORACLES[name]) is None
