"""Column layouts of the change feeds and the names of the kept tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Sentinel category of a fact whose item has no known category. Fixed value.
UNKNOWN_CATEGORY = 999999

# Reach of the windowed stream joins, in minutes. Fixed value.
JOIN_REACH_MINUTES = 50


def _feed(*fields: tuple[str, T.DataType]) -> T.StructType:
    """A feed's own fields, then event time and arrival order."""
    ordering = (("ts", T.TimestampType()), ("seq", T.LongType()))
    return T.StructType([T.StructField(n, t) for n, t in (*fields, *ordering)])


ITEM = _feed(("item_id", T.LongType()), ("category_id", T.LongType()))
CUSTOMER = _feed(("customer_id", T.LongType()), ("name", T.StringType()))
CATEGORY = _feed(("category_id", T.LongType()), ("name", T.StringType()))
REPLENISHMENT = _feed(("item_id", T.LongType()), ("quantity", T.LongType()))
SALE = _feed(("item_id", T.LongType()), ("customer_id", T.LongType()), ("quantity", T.LongType()))
RETURN = SALE

KEY_VALUE = T.StructType(
    [T.StructField("key", T.LongType()), T.StructField("value", T.LongType())]
)

# Public names of the kept totals -> (table they are read from, column). Fixed
# values: readers of the tables ask for them by these names. Each has a
# "<name>-store" (all spine keys, zero filled) and a "<name>-topic" (the same
# rows as published); the single totals also have a "<name>-store-0.8" (keys
# seen in the facts, not joined to the spine).
TOTAL_NAMES = {
    "refill-qty-by-item": ("item_totals", "replenished"),
    "sale-qty-by-item": ("item_totals", "sold"),
    "rets-qty-by-item": ("item_totals", "returned"),
    "sale-qty-by-cust": ("customer_totals", "sold"),
    "rets-qty-by-cust": ("customer_totals", "returned"),
    "refill-qty-by-cat": ("category_totals", "replenished"),
    "sale-qty-by-cat": ("category_totals", "sold"),
    "rets-qty-by-cat": ("category_totals", "returned"),
    "items-at-hand": ("item_totals", "at_hand"),
    "items-with-cust": ("customer_totals", "held"),
    "items-at-hand-per-cat": ("category_totals", "at_hand"),
}

# Latest-value tables of the three dimensions. Fixed values.
LATEST_NAMES = {
    "item-store": ("item_totals", "category_id"),
    "customer-store": ("customer_latest", "name"),
    "category-store": ("category_latest", "name"),
}
