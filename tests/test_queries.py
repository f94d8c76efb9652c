"""Every registered query against its SQL, on the smallest test tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from acreage.plans.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() == 118


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), SQL[name], con) > 0
