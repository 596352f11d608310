"""Each named query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tallyline.registry import oracle, queries
from tests.compare import connect, difference

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).columns[:3] == ["awsaccountid", "instancearn", "channel"]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, db, name):
    assert difference(QUERIES[name](spark, sf), db, ORACLE[name]) is None
