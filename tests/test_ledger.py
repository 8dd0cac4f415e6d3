"""Edge cases of the eleven totals on hand-made feeds."""

import pytest
from pyspark.errors import PySparkException

from stockledger.plans import GivenFeeds, Ledger
from tests.conftest import rows


def feeds(spark, item=(), customer=(), category=(), replenishment=(), sale=(), ret=()):
    make = lambda values, schema: spark.createDataFrame(list(values), schema)
    return GivenFeeds(
        item=make(item, "item_id bigint, category_id bigint, seq bigint"),
        customer=make(customer, "customer_id bigint, name string, seq bigint"),
        category=make(category, "category_id bigint, name string, seq bigint"),
        replenishment=make(replenishment, "item_id bigint, quantity bigint"),
        sale=make(sale, "item_id bigint, customer_id bigint, quantity bigint"),
        ret=make(ret, "item_id bigint, customer_id bigint, quantity bigint"),
    )


SMALL = dict(
    item=[(1, 10, 1), (2, 20, 2), (3, 10, 3), (1, 20, 4)],
    customer=[(7, "g", 1), (8, "h", 2), (20, "t", 3)],
    category=[(10, "ten", 1), (20, "twenty", 2)],
    replenishment=[(1, 100), (2, 50), (99, 5)],
    sale=[(1, 7, 30), (2, 8, 20), (2, 77, 1), (99, 7, 2)],
    ret=[(1, 7, 4)],
)


@pytest.fixture(scope="module")
def ledger(spark):
    return Ledger(feeds(spark, **SMALL))


def test_by_item(ledger):
    assert rows(ledger.replenished_by_item()) == [(1, 100), (2, 50), (3, 0)]
    assert rows(ledger.sold_by_item()) == [(1, 30), (2, 21), (3, 0)]
    assert rows(ledger.returned_by_item()) == [(1, 4), (2, 0), (3, 0)]
    assert rows(ledger.items_at_hand()) == [(1, 74), (2, 29), (3, 0)]


def test_by_customer(ledger):
    assert rows(ledger.sold_by_customer()) == [(7, 32), (8, 20), (20, 0)]
    assert rows(ledger.returned_by_customer()) == [(7, 4), (8, 0), (20, 0)]
    assert rows(ledger.items_with_customer()) == [(7, 28), (8, 20), (20, 0)]


def test_by_latest_category(ledger):
    assert rows(ledger.replenished_by_category()) == [(10, 0), (20, 150)]
    assert rows(ledger.sold_by_category()) == [(10, 0), (20, 51)]
    assert rows(ledger.returned_by_category()) == [(10, 0), (20, 4)]
    assert rows(ledger.items_at_hand_by_category()) == [(10, 0), (20, 103)]


def test_raw_keeps_what_the_dimension_lacks(ledger):
    assert rows(ledger.raw_by_item("replenished")) == [(1, 100), (2, 50), (99, 5)]
    assert rows(ledger.raw_by_customer("sold")) == [(7, 32), (8, 20), (77, 1)]
    assert rows(ledger.raw_by_category("replenished")) == [(20, 150), (999999, 5)]
    assert rows(ledger.raw_by_category("returned")) == [(20, 4)]


def test_as_wired_lays_categories_over_customers(ledger):
    assert rows(ledger.replenished_by_category_as_wired()) == [(7, 0), (8, 0), (20, 150)]
    assert rows(ledger.items_at_hand_by_category_as_wired()) == [(7, 0), (8, 0), (20, 103)]


def test_as_wired_ignores_sales_of_ids_that_are_no_category(spark):
    small = {**SMALL, "category": [(10, "ten", 1)]}
    ledger = Ledger(feeds(spark, **small))
    assert rows(ledger.items_at_hand_by_category_as_wired()) == [(7, 0), (8, 0), (20, 154)]


def test_without_spine(ledger):
    assert rows(ledger.sold_minus_returned_no_spine()) == [(7, 28), (8, 20), (77, 1)]
    assert rows(ledger.stock_by_category_no_spine()) == [(20, 103), (999999, 3)]


def test_sentinel_can_be_a_real_category(spark):
    small = {**SMALL, "category": [(999999, "rest", 1)]}
    assert rows(Ledger(feeds(spark, **small)).sold_by_category()) == [(999999, 2)]


def test_negative_quantity_fails_by_category_only(spark):
    ledger = Ledger(feeds(spark, **{**SMALL, "sale": [(1, 7, 5), (1, 7, -3)]}))
    assert rows(ledger.sold_by_item()) == [(1, 2), (2, 0), (3, 0)]
    assert rows(ledger.sold_by_customer()) == [(7, 2), (8, 0), (20, 0)]
    with pytest.raises(PySparkException, match="must not be negative"):
        ledger.sold_by_category().collect()


def test_null_quantity_fails(spark):
    ledger = Ledger(feeds(spark, **{**SMALL, "sale": [(1, 7, None)]}))
    with pytest.raises(PySparkException, match="must not be null"):
        ledger.sold_by_item().collect()
