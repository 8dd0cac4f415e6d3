"""Every registered query against its SQL twin, over whole tables."""

import pytest

import __spark_entry__ as registered
from tests import oracle

QUERIES, ORACLES = registered.queries(), registered.ORACLES


@pytest.fixture(scope="module")
def con(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, data, con, name):
    assert oracle.differences(QUERIES[name](spark, data), con, ORACLES[name]) == ""


def test_every_query_has_a_twin():
    assert set(registered.QUERIES) == set(ORACLES)


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["item_id", "quantity"] and df.count() > 0
