"""The ledger's feeds read from order tables: orders, lineitem, part and customer.

A lineitem is a sale to the order's customer, and a return too when flagged 'R';
first lines also replenish. Parts are items and their size is the category.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.functions import required
from stockledger.operators.spread import spread, tasks_for
from stockledger.plans.feeds import Feeds, GivenFeeds


# Column types of the tables read here, so that reading one opens no file to find out.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


@dataclass(frozen=True)
class OrderTables:
    """The parquet tables of one directory, each ``<dir>/<name>.parquet``."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    def stream(self, name: str, files_per_batch: int | None = None) -> DataFrame:
        """The table as a stream of its files. The trailing glob also takes a lone file."""
        reader = self.spark.readStream.schema(SCHEMAS[name])
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(f"{self.path}/{name}.parquet*")

    def feeds(self) -> OrderFeeds:
        return OrderFeeds(self.table)

    def item_changes(self) -> DataFrame:
        return item_changes(self.table("part"))

    def timed_sales(self) -> DataFrame:
        return timed_sales(self.table("lineitem"), self.table("orders"))


class OrderFeeds(Feeds):
    """Feeds whose sales and returns are two readings of the same rows.

    Plans that need both take them from ``traded`` (item_id, customer_id, sold,
    returned), so lineitem is scanned and joined to its order once, not twice.
    Lineitem and orders may come from different readers: a stream of lines joins
    a static table of orders.
    """

    def __init__(
        self,
        table: Callable[[str], DataFrame],
        orders: Callable[[str], DataFrame] | None = None,
    ):
        self._table = table
        self._orders = orders or table

    @property
    def item(self) -> DataFrame:
        return items(self._table("part"))

    @property
    def customer(self) -> DataFrame:
        return customers(self._table("customer"))

    @property
    def category(self) -> DataFrame:
        return categories(self._orders("part"))

    @property
    def replenishment(self) -> DataFrame:
        return replenishments(self._table("lineitem"))

    @property
    def sale(self) -> DataFrame:
        return sales(self._table("lineitem"), self._orders("orders"))

    @property
    def ret(self) -> DataFrame:
        return returns(self._table("lineitem"), self._orders("orders"))

    @property
    def traded(self) -> DataFrame:
        return traded(self._table("lineitem"), self._orders("orders"))

    def moves(self, key: str, kinds: Sequence[str]) -> DataFrame:
        both = [k for k in kinds if k in ("sold", "returned")]
        if len(both) < 2:
            return super().moves(key, kinds)
        rows = self.traded.select(required(key, key).alias(key), *both)
        others = [k for k in kinds if k not in both]
        if not others:
            return rows
        return rows.unionByName(super().moves(key, others), allowMissingColumns=True)


# A feed that sends every key once takes any arrival order.
_ONCE = "CAST(0 AS BIGINT) AS seq"
_QUANTITY = "CAST(l_quantity AS BIGINT) AS quantity"
_SHIPPED = "CAST(l_shipdate AS TIMESTAMP)"


def items(part: DataFrame) -> DataFrame:
    """Every 50th part is left out; its facts have no category."""
    return part.where("p_partkey % 50 <> 0").selectExpr(
        "p_partkey AS item_id", "CAST(p_size AS BIGINT) AS category_id", _ONCE
    )


def customers(customer: DataFrame) -> DataFrame:
    return customer.selectExpr("c_custkey AS customer_id", "c_name AS name", _ONCE)


def categories(part: DataFrame) -> DataFrame:
    sizes = part.selectExpr("CAST(p_size AS BIGINT) AS category_id").distinct()
    return sizes.selectExpr("category_id", "concat('CATEGORY_', category_id) AS name", _ONCE)


def replenishments(lineitem: DataFrame, *more: str) -> DataFrame:
    """First lines, twice the quantity; items divisible by seven are never replenished."""
    return lineitem.where("l_linenumber = 1 AND l_partkey % 7 <> 0").selectExpr(
        "l_partkey AS item_id", "CAST(l_quantity AS BIGINT) * 2 AS quantity", *more
    )


def sales(lineitem: DataFrame, orders: DataFrame, *more: str) -> DataFrame:
    return _lines(lineitem, orders).selectExpr("item_id", "customer_id", _QUANTITY, *more)


def returns(lineitem: DataFrame, orders: DataFrame, *more: str) -> DataFrame:
    return sales(lineitem.where("l_returnflag = 'R'"), orders, *more)


def traded(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Sold, and returned where the line was, of every line."""
    quantity = required("l_quantity", "quantity")
    lines = _lines(lineitem, orders).select(
        "item_id", "customer_id", quantity.alias("sold"), "l_returnflag"
    )
    return lines.selectExpr(
        "item_id", "customer_id", "sold", "IF(l_returnflag = 'R', sold, NULL) AS returned"
    )


def timed_sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return sales(
        lineitem, orders, f"{_SHIPPED} AS ts", "l_orderkey * 10 + l_linenumber AS seq"
    )


def timed_feeds(
    table: Callable[[str], DataFrame], orders: Callable[[str], DataFrame] | None = None
) -> GivenFeeds:
    """All feeds with their arrival order: the microseconds of the ship date or change."""
    lines, orders = table("lineitem"), (orders or table)("orders")
    shipped = f"unix_micros({_SHIPPED}) AS seq"
    return GivenFeeds(
        item=item_changes(table("part")).withColumn("seq", F.unix_micros("ts")),
        customer=customers(table("customer")),
        category=category_changes(table("part")),
        replenishment=replenishments(lines, shipped),
        sale=sales(lines, orders, shipped),
        ret=returns(lines, orders, shipped),
    )


def _lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their order's customer."""
    tasks = tasks_for(lineitem, orders) if tasks_for(orders) else None  # few orders are broadcast
    lineitem, orders = spread(lineitem, tasks, "l_orderkey"), spread(orders, tasks, "o_orderkey")
    joined = lineitem.join(orders, F.expr("l_orderkey = o_orderkey"))
    return joined.selectExpr("*", "l_partkey AS item_id", "o_custkey AS customer_id")


def item_changes(part: DataFrame) -> DataFrame:
    """Versions of the items: every 11th appears late, every third changes category."""
    known = part.where("p_partkey % 50 <> 0")
    first = known.selectExpr(
        "p_partkey AS item_id",
        "CAST(p_size AS BIGINT) AS category_id",
        "CAST(IF(p_partkey % 11 = 0, '1996-01-01', '1990-01-01') AS TIMESTAMP) AS ts",
        "p_partkey * 2 AS seq",
    )
    moved = known.where("p_partkey % 3 = 0").selectExpr(
        "p_partkey AS item_id",
        "CAST(p_size % 50 + 1 AS BIGINT) AS category_id",
        "TIMESTAMP '1998-01-01' AS ts",
        "p_partkey * 2 + 1 AS seq",
    )
    return first.unionByName(moved)


def customer_changes(customer: DataFrame, orders: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """A customer's name as first entered, then as each order re-sends it with its priority.

    A stream of orders takes the names from a static table ``named``.
    """
    entered = customer.selectExpr(
        "c_custkey AS customer_id", "c_name AS name", "CAST(-1 AS BIGINT) AS seq"
    )
    resent = orders.join(customer if named is None else named, F.expr("o_custkey = c_custkey")).selectExpr(
        "c_custkey AS customer_id",
        "concat_ws(' ', c_name, o_orderpriority) AS name",
        "o_orderkey AS seq",
    )
    return entered.unionByName(resent)


def category_changes(part: DataFrame) -> DataFrame:
    """Each part names its category anew."""
    return part.selectExpr(
        "CAST(p_size AS BIGINT) AS category_id", "p_name AS name", "p_partkey AS seq"
    )


def event_stream(events: DataFrame) -> DataFrame:
    """Events with a time Spark can set a watermark on, and the value in cents."""
    return events.selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "user_id",
        "event_type",
        "CAST(round(value * 100) AS BIGINT) AS cents",
    )
