
from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # however this file is loaded

from stockledger.functions import (  # noqa: E402
    long_to_bytes,
    non_negative,
    or_unknown,
    strict_long,
    upper_line,
    zero_fill,
)
from stockledger.operators import (  # noqa: E402
    asof_lookup,
    asof_totals,
    interval_left_join,
    interval_left_sum,
    latest_by_key,
    reduce_by_key,
    rekey,
    signed_sum,
    snapshot_lookup,
    split_negative,
    split_unparsable,
    sum_by_key,
    windowed_total,
)
from stockledger.plans import GivenFeeds, Ledger  # noqa: E402
from stockledger.schemas import UNKNOWN_CATEGORY  # noqa: E402
from stockledger.sources import reads  # noqa: E402
from stockledger.sources.changes import json_changes, long_pairs, pull_after  # noqa: E402
from stockledger.sources.kept import BatchLog, KeptTables, shared_dir  # noqa: E402
from stockledger.sources.sinks import json_documents, latest_of_changes, published, published_stock, topic_records  # noqa: E402
from stockledger.sources.tables import (  # noqa: E402
    OrderFeeds,
    OrderTables,
    category_changes,
    customer_changes,
    event_stream,
    timed_feeds,
)
from stockledger.streaming import (  # noqa: E402
    BoundedWindows,
    CheckedFeed,
    closing_row,
    keep,
    keep_category_rows,
    keep_category_totals,
    keep_interval_join,
    keep_interval_left_sums,
    keep_regrouped,
    keep_windows,
    latest_names,
)

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Items at hand: replenished less sold plus returned, for every item."""
    return queries()["q9_items_at_hand"](spark, SMOKE_DIR)


def _ledger(build: Callable[[Ledger], DataFrame]):
    def run(tables: OrderTables) -> DataFrame:
        return build(Ledger(tables.feeds()))

    return run


# Sources and sinks.


def read_changes_count(t: OrderTables) -> DataFrame:
    """Records of each feed; sales and returns are two readings of one join."""
    feeds = t.feeds()
    single = {
        "item": feeds.item,
        "customer": feeds.customer,
        "category": feeds.category,
        "replenishment": feeds.replenishment,
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("feed"), "records")
        for name, df in single.items()
    ]
    both = feeds.traded.agg(F.count(F.lit(1)).alias("sale"), F.count("returned").alias("return"))
    counts.append(both.selectExpr("stack(2, 'sale', sale, 'return', `return`) AS (feed, records)"))
    return reduce(DataFrame.unionByName, counts)


def json_changes_sale(t: OrderTables) -> DataFrame:
    """Sales as JSON records, decoded field by field and totalled by item."""
    sold = t.timed_sales()
    records = sold.select(F.to_json(F.struct("item_id", "quantity")).alias("value"), "ts", "seq")
    fields = "item_id bigint, quantity bigint"
    return sum_by_key(json_changes(records, T.StructType.fromDDL(fields)), "item_id", "quantity")


def incremental_pull(t: OrderTables) -> DataFrame:
    """Lines of orders newer than all orders dated before 1995-01-03."""
    orders = t.table("orders")
    seen = orders.where(F.col("o_orderdate") < F.lit("1995-01-03").cast("timestamp_ntz"))
    return pull_after(orders, "o_orderkey", seen).select("o_orderkey", "o_custkey")


def changelog_changes(t: OrderTables) -> DataFrame:
    """What each batch of a stream changed: the new sold-by-item totals, kept batch by batch."""
    return _sold_log(t).changes("sold").select("key", F.col("quantity").alias("value"), "batch_id")


def changelog_latest(t: OrderTables) -> DataFrame:
    return latest_of_changes(changelog_changes(t), "key", ["value"])


def published_topics(t: OrderTables) -> DataFrame:
    """All eleven totals as the rows of their topics: one pass of the lines by item and category, one by customer."""
    ledger = Ledger(t.feeds())
    customers = published(ledger.customer_totals(), "customer_totals", "customer_id")
    return published_stock(ledger).unionByName(customers)


def items_json(t: OrderTables) -> DataFrame:
    return json_documents(_hand(t))


def long_topic_records(t: OrderTables) -> DataFrame:
    """Items at hand as topic bytes, shown in hex, and read back."""
    records = topic_records(_hand(t))
    shown = records.select("*", F.hex("key").alias("ts"), F.hex("value").alias("seq"))
    return long_pairs(shown).withColumnsRenamed({"ts": "key_hex", "seq": "value_hex"})


# Projections and checks.


def rekey_sale_item(t: OrderTables) -> DataFrame:
    return rekey(t.feeds().sale, "item_id", "quantity")


def rekey_sale_customer(t: OrderTables) -> DataFrame:
    return rekey(t.feeds().sale, "customer_id", "quantity")


def parse_strict(t: OrderTables) -> DataFrame:
    """Key and value of every event, both reached through text."""
    events = t.table("events")
    key = strict_long(F.col("user_id").cast("string"), "user_id")
    return rekey(events, key, strict_long(F.get_json_object("props", "$.k"), "k"))


def _page_numbers(t: OrderTables) -> tuple[DataFrame, DataFrame]:
    segment = F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1)
    pages = t.table("pages").select("page_id", segment.alias("number"))
    return split_unparsable(pages, ["number"])


def parse_accepts(t: OrderTables) -> DataFrame:
    return _page_numbers(t)[0]


def parse_rejects(t: OrderTables) -> DataFrame:
    return _page_numbers(t)[1]


def _balances(t: OrderTables) -> tuple[DataFrame, DataFrame]:
    balances = t.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.floor("c_acctbal").cast("bigint").alias("quantity"),
    )
    return split_negative(balances)


def negative_rejects(t: OrderTables) -> DataFrame:
    return _balances(t)[1]


def non_negative_total(t: OrderTables) -> DataFrame:
    """The failing check over rows the permissive one has passed."""
    checked = non_negative("quantity")
    return _balances(t)[0].agg(F.sum(checked).alias("quantity"), F.count(checked).alias("n"))


def _lines(t: OrderTables) -> DataFrame:
    lines = F.explode(F.split("text", "\n"))
    return t.table("documents").select("doc_id", lines.alias("value"))


def uppercase_lines(t: OrderTables) -> DataFrame:
    return _lines(t).select("doc_id", upper_line("value").alias("value"))


def original_and_upper(t: OrderTables) -> DataFrame:
    return _lines(t).select("value", upper_line("value").alias("upper_value"))


# Lookups and joins.


def sale_snapshot_category(t: OrderTables) -> DataFrame:
    """Every sale with its item's latest category, row by row."""
    latest = latest_by_key(t.item_changes(), "item_id", ["category_id"])
    return snapshot_lookup(t.feeds().sale, latest, "item_id", default=UNKNOWN_CATEGORY)


def asof_sale_by_category(t: OrderTables) -> DataFrame:
    return asof_totals(
        t.timed_sales(), t.item_changes(), "item_id", "category_id", ["quantity"], UNKNOWN_CATEGORY,
        bucket=timedelta(days=1),
    )


def asof_sale_rows(t: OrderTables) -> DataFrame:
    rows = asof_lookup(
        t.timed_sales(), t.item_changes(), "item_id", "category_id", UNKNOWN_CATEGORY,
        bucket=timedelta(days=1),
    )
    return rows.select("item_id", "customer_id", "quantity", "category_id")


def asof_user_state(t: OrderTables) -> DataFrame:
    """Every purchase with the user's last change before it; logins change to nothing, some users are null."""
    events = event_stream(t.table("events"))
    user = F.expr("nullif(user_id, 7)").alias("user_id")
    changes = events.where("event_type <> 'purchase'").select(
        user, "ts", "event_id", F.expr("nullif(cents, cents % 3)").alias("state")
    )
    facts = events.where("event_type = 'purchase'").select(user, "ts", "event_id", "cents")
    return asof_lookup(facts, changes, "user_id", "state", seq="event_id", bucket=timedelta(days=1)).drop("ts")


def _clicks_and_purchases(t: OrderTables) -> tuple[DataFrame, DataFrame]:
    events = event_stream(t.table("events"))
    columns = ["user_id", "ts", "event_id", "cents"]
    return (
        events.where("event_type = 'click'").select(columns),
        events.where("event_type = 'purchase'").select(columns),
    )


def interval_left(t: OrderTables) -> DataFrame:
    clicks, purchases = _clicks_and_purchases(t)
    return interval_left_join(clicks, purchases, "user_id").select(
        "user_id",
        F.col("event_id").alias("click_id"),
        F.col("right_event_id").alias("purchase_id"),
        F.col("right_cents").alias("cents"),
    )


def interval_left_salted(t: OrderTables) -> DataFrame:
    clicks, purchases = _clicks_and_purchases(t)
    return interval_left_join(clicks, purchases, "user_id", salts=4).select(
        "user_id",
        F.col("event_id").alias("click_id"),
        F.col("right_event_id").alias("purchase_id"),
        F.col("right_cents").alias("cents"),
    )


def interval_sum(t: OrderTables) -> DataFrame:
    clicks, purchases = _clicks_and_purchases(t)
    return interval_left_sum(clicks, purchases, "user_id", "cents")


# Aggregates.


def item_latest(t: OrderTables) -> DataFrame:
    return latest_by_key(t.item_changes(), "item_id", ["category_id"])


def customer_latest(t: OrderTables) -> DataFrame:
    changes = customer_changes(t.table("customer"), t.table("orders"))
    return latest_by_key(changes, "customer_id", ["name"])


def category_latest(t: OrderTables) -> DataFrame:
    return latest_by_key(category_changes(t.table("part")), "category_id", ["name"])


def reduce_min_max(t: OrderTables) -> DataFrame:
    return reduce_by_key(t.feeds().sale, "customer_id", "quantity", ["min", "max", "sum"])


def reduce_latest(t: OrderTables) -> DataFrame:
    orders = t.table("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("seq"),
    )
    return reduce_by_key(orders, "customer_id", "status", "latest")


def aggregate_sum(t: OrderTables) -> DataFrame:
    return sum_by_key(t.feeds().ret, "customer_id", "quantity")


def signed_retract_sum(t: OrderTables) -> DataFrame:
    """Sales add to an item's total, returns take back."""
    feeds = t.feeds()
    changes = feeds.sale.select("item_id", F.lit("+").alias("sign"), "quantity").unionByName(
        feeds.ret.select("item_id", F.lit("-").alias("sign"), "quantity")
    )
    return signed_sum(changes, "item_id", "quantity")


def _windows(df: DataFrame) -> DataFrame:
    return df.select(
        "event_type",
        F.unix_millis("window_start").alias("window_start_ms"),
        F.col("total"),
    )


def windowed_count_tumbling(t: OrderTables) -> DataFrame:
    return _windows(windowed_total(event_stream(t.table("events")), "event_type", "ts", "1 day"))


def windowed_count_hopping(t: OrderTables) -> DataFrame:
    events = event_stream(t.table("events"))
    return _windows(windowed_total(events, "event_type", "ts", "2 days", "1 day"))


def windowed_sum_hopping(t: OrderTables) -> DataFrame:
    events = event_stream(t.table("events"))
    return _windows(windowed_total(events, "event_type", "ts", "2 days", "1 day", "cents"))


# Reads.


def _hand(t: OrderTables) -> DataFrame:
    return rekey(Ledger(t.feeds()).items_at_hand(), "item_id", "quantity")


def _kept(t: OrderTables, table: str, rows: DataFrame) -> KeptTables:
    """The rows published as a kept table of two batches, the first of them sealed in a snapshot."""
    tables = KeptTables(t.spark, f"{_work_dir(t)}/kept", epoch=1)
    tables.publish(table, rows, 0)
    tables.publish(table, tables.changes(table).drop("batch_id").where("key IS NULL"), 1)
    return tables


def _kept_hand(t: OrderTables) -> DataFrame:
    totals = Ledger(t.feeds()).item_totals().withColumnRenamed("item_id", "key")
    return _kept(t, "item_totals", totals).named("items-at-hand-store")


def lookup_by_key(t: OrderTables) -> DataFrame:
    return reads.by_key(_kept_hand(t), 42)


def scan_all(t: OrderTables) -> DataFrame:
    return _kept_hand(t)


def key_range(t: OrderTables) -> DataFrame:
    return reads.key_range(_kept_hand(t), 100, 1500)


def window_fetch(t: OrderTables) -> DataFrame:
    daily = windowed_total(event_stream(t.table("events")), "event_type", "ts", "1 day")
    keyed = F.struct(F.col("event_type").alias("of"), "window_start").alias("key")
    tables = _kept(t, "daily", daily.select(keyed, "window_end", "total"))
    return reads.window_fetch(tables.windows("daily"), "key", "click", 1704153600000, 1705276800000)


# Streams: a table's rows arrive in slices, each a run of the stream that goes on from the last
# one's checkpoint; what is kept is then read.

SLICES = 4
_DAY = 24 * 3600 * 1_000_000

# Ship dates at which the slices of timed feeds begin, in microseconds.
_SLICE_STARTS = [757382400000000, 820454400000000, 883612800000000]
_SLICE_OF = "CASE " + " ".join(f"WHEN {{0}} < {s} THEN {i}" for i, s in enumerate(_SLICE_STARTS)) + " ELSE 3 END"


def _work_dir(t: OrderTables) -> str:
    """A new folder under the one that all executors share."""
    return f"{shared_dir(t.spark)}/registered/{uuid.uuid4().hex}"


def _arrivals(rows: dict[str, DataFrame], slice_of: dict[str, str], folder: str) -> Iterator[None]:
    """Append the rows of every table, slice by slice, to its folder of files.

    They are divided once, so a table that is a join is joined once, not for every slice.
    """
    divided = f"{folder}-divided"
    for name, df in rows.items():
        df.withColumn("__slice", F.expr(slice_of[name]).cast("int")).write.partitionBy("__slice").parquet(f"{divided}/{name}")
    for k in range(SLICES):
        for name, df in rows.items():
            schema = T.StructType([*df.schema, T.StructField("__slice", T.IntegerType())])
            whole = df.sparkSession.read.schema(schema).parquet(f"{divided}/{name}")
            arrived = whole.where(F.col("__slice") == k).select(*df.columns)
            arrived.write.mode("append").parquet(f"{folder}/{name}.parquet")
        yield


# What the feeds read of a line; the other columns need not be copied to arrive.
_LINE = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")


def _streamed(t: OrderTables, slice_of: dict[str, str], start: Callable[[OrderTables, str], StreamingQuery]) -> None:
    """Run the stream that ``start`` builds once for every slice of the tables."""
    folder = f"{_work_dir(t)}/in"
    arriving = OrderTables(t.spark, folder)
    rows = {n: t.table(n).select(*_LINE) if n == "lineitem" else t.table(n) for n in slice_of}
    for _ in _arrivals(rows, slice_of, folder):
        start(arriving, f"{folder}/../checkpoint").awaitTermination()


def _by_hash(*names: str) -> dict[str, str]:
    first = {"lineitem": "l_orderkey", "part": "p_partkey", "customer": "c_custkey", "orders": "o_orderkey", "events": "event_id"}
    return {n: f"pmod(xxhash64({first[n]}), {SLICES})" for n in names}


def _new_tables(t: OrderTables) -> KeptTables:
    return KeptTables(t.spark, f"{_work_dir(t)}/kept", epoch=2)


def _sold_log(t: OrderTables) -> KeptTables:
    tables = _new_tables(t)
    shipped = {"lineitem": _SLICE_OF.format("unix_micros(CAST(l_shipdate AS TIMESTAMP))")}

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        sold = OrderFeeds(arriving.stream, t.table).sale
        return keep(sum_by_key(sold, "item_id", "quantity"), tables, "sold", "item_id", checkpoint, availableNow=True)

    _streamed(t, shipped, start)
    return tables


def stream_items_at_hand(t: OrderTables) -> DataFrame:
    tables = _new_tables(t)

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        live = Ledger(OrderFeeds(arriving.stream, t.table)).item_totals()
        return keep(live, tables, "item_totals", "item_id", checkpoint, availableNow=True)

    _streamed(t, _by_hash("lineitem", "part"), start)
    return tables.named("items-at-hand-store")


def stream_items_with_customer(t: OrderTables) -> DataFrame:
    tables = _new_tables(t)

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        live = Ledger(OrderFeeds(arriving.stream, t.table)).customer_totals()
        return keep(live, tables, "customer_totals", "customer_id", checkpoint, availableNow=True)

    _streamed(t, _by_hash("lineitem", "customer"), start)
    return tables.named("items-with-cust-store")


def _totals_at_arrival(t: OrderTables) -> KeptTables:
    """Category totals and items kept from all facts in order of their time."""
    timed, names = timed_feeds(t.table), ("item", "customer", "category", "replenishment", "sale", "ret")
    rows = {n: getattr(timed, n) for n in names}
    work, tables = _work_dir(t), _new_tables(t)
    for _ in _arrivals(rows, dict.fromkeys(names, _SLICE_OF.format("seq")), f"{work}/in"):
        live = GivenFeeds(
            **{n: t.spark.readStream.schema(df.schema).parquet(f"{work}/in/{n}.parquet") for n, df in rows.items()}
        )
        keep_category_totals(
            live, tables, f"{work}/checkpoint", bucket=_DAY, availableNow=True
        ).awaitTermination()
    return tables


def stream_category_totals_at_arrival(t: OrderTables) -> DataFrame:
    """All facts in order of their time, each under the category its item then had."""
    tables = _totals_at_arrival(t)
    names = ("refill-qty-by-cat", "sale-qty-by-cat", "rets-qty-by-cat", "items-at-hand-per-cat")
    stores = [f"{n}-store" for n in names] + [f"{n}-store-0.8" for n in names[:3]]
    return reduce(
        DataFrame.unionByName,
        [tables.named(s).select(F.lit(s).alias("name"), "key", "value") for s in stores],
    )


def stream_category_rows(t: OrderTables) -> DataFrame:
    """Sales one by one with the category their item had when they came."""
    timed, work = timed_feeds(t.table), _work_dir(t)
    rows = {"sale": timed.sale, "item": timed.item}
    tables, log = _new_tables(t), BatchLog(t.spark, f"{work}/out")
    for _ in _arrivals(rows, dict.fromkeys(rows, _SLICE_OF.format("seq")), f"{work}/in"):
        sale, item = (
            t.spark.readStream.schema(df.schema).parquet(f"{work}/in/{n}.parquet") for n, df in rows.items()
        )
        facts = sale.withColumn("kind", F.lit("sold"))
        keep_category_rows(
            facts, item, tables, log, "sales", f"{work}/checkpoint", bucket=_DAY, availableNow=True
        ).awaitTermination()
    return log.read("sales", "category_id bigint, kind string, quantity bigint")


def stream_windowed_count(t: OrderTables) -> DataFrame:
    """Windows of events in any order: without a watermark none is late."""
    tables = _new_tables(t)

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        live = windowed_total(event_stream(arriving.stream("events")), "event_type", "ts", "2 days", "1 day")
        return keep_windows(live, tables, "counts", "event_type", checkpoint, availableNow=True)

    _streamed(t, _by_hash("events"), start)
    return _windows(tables.windows("counts").withColumnRenamed("key", "event_type"))


def stream_window_fetch(t: OrderTables) -> DataFrame:
    """One key's windows of a store that a stream fills."""
    tables = _new_tables(t)

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        live = windowed_total(event_stream(arriving.stream("events")), "event_type", "ts", "1 day")
        return keep_windows(live, tables, "daily", "event_type", checkpoint, availableNow=True)

    _streamed(t, _by_hash("events"), start)
    return reads.window_fetch(tables.windows("daily"), "key", "click", 1704153600000, 1705276800000)


# Days of January 2024 at which the slices of the events begin.
_EVENT_SLICE = "CASE WHEN ts < '2024-01-09' THEN 0 WHEN ts < '2024-01-16' THEN 1 WHEN ts < '2024-01-23' THEN 2 ELSE 3 END"
_EVENTS_END = datetime(2030, 1, 1)


def _live_clicks(t: OrderTables, start: Callable[[DataFrame, DataFrame, str], StreamingQuery], closed: bool = True) -> None:
    """Run a stream of clicks and purchases, the purchases a slice behind, until rows that close both feeds where it needs them."""
    clicks, purchases = _clicks_and_purchases(t)
    rows, work = {"clicks": clicks, "purchases": purchases}, _work_dir(t)
    slices = {"clicks": _EVENT_SLICE, "purchases": f"least({_EVENT_SLICE} + 1, {SLICES - 1})"}

    def go_on() -> None:
        live = [t.spark.readStream.schema(df.schema).parquet(f"{work}/in/{n}.parquet") for n, df in rows.items()]
        start(*live, f"{work}/checkpoint").awaitTermination()

    for _ in _arrivals(rows, slices, f"{work}/in"):
        go_on()
    if not closed:
        return
    for n, df in rows.items():
        closing_row(df, _EVENTS_END, "user_id", -1).write.mode("append").parquet(f"{work}/in/{n}.parquet")
    go_on()


def stream_interval_left(t: OrderTables) -> DataFrame:
    """Clicks with the purchases within 50 minutes, joined live."""
    log, joined = BatchLog(t.spark, f"{_work_dir(t)}/log"), []

    def start(clicks: DataFrame, purchases: DataFrame, checkpoint: str) -> StreamingQuery:
        joined[:] = [interval_left_join(clicks, purchases, "user_id", late="1 hour").schema]
        return keep_interval_join(
            clicks, purchases, "user_id", log, "pairs", checkpoint, late="1 hour", availableNow=True
        )

    _live_clicks(t, start)
    return log.read("pairs", joined[0]).where(F.col("ts") < F.lit(_EVENTS_END)).select(
        "user_id",
        F.col("event_id").alias("click_id"),
        F.col("right_event_id").alias("purchase_id"),
        F.col("right_cents").alias("cents"),
    )


def stream_interval_sum(t: OrderTables) -> DataFrame:
    """Per user, the running sum of the purchases that clicks met, kept live."""
    log, tables = BatchLog(t.spark, f"{_work_dir(t)}/log"), _new_tables(t)

    def start(clicks: DataFrame, purchases: DataFrame, checkpoint: str) -> StreamingQuery:
        return keep_interval_left_sums(
            clicks, purchases, "user_id", "cents", log, tables, "bought", checkpoint, late=timedelta(hours=1), availableNow=True
        )

    _live_clicks(t, start, closed=False)
    return tables.view("bought").withColumnRenamed("key", "user_id")


def stream_retracted_by_category(t: OrderTables) -> DataFrame:
    """Sold by category after every batch: an item that moves, or sells, is taken back with its old total and added with its new one."""
    timed, work, tables = timed_feeds(t.table), _work_dir(t), _new_tables(t)
    rows = {"sale": timed.sale, "item": timed.item}

    def regroup(batch_id: int) -> None:
        keep_regrouped(
            tables, "item_totals", "by_category", batch_id,
            lambda row: or_unknown(row["category_id"]), lambda row: zero_fill(row["sold"]),
        )

    for _ in _arrivals(rows, dict.fromkeys(rows, _SLICE_OF.format("seq")), f"{work}/in"):
        sale, item = (
            t.spark.readStream.schema(df.schema).parquet(f"{work}/in/{n}.parquet") for n, df in rows.items()
        )
        live = Ledger(GivenFeeds(item, item, item, sale, sale, sale)).item_totals(["sold"], ["category_id"])
        keep(
            live, tables, "item_totals", "item_id", f"{work}/checkpoint", only_changed=True, then=regroup, availableNow=True
        ).awaitTermination()
    after = [
        tables.view_at("by_category", n).where("members > 0").select(
            F.lit(n).cast("bigint").alias("batch_id"), F.col("key").alias("category_id"), F.col("value").alias("quantity"), "members"
        )
        for n in range(tables.last_common("item_totals", "by_category") + 1)
    ]
    return reduce(DataFrame.unionByName, after)


def changelog_real_changes(t: OrderTables) -> DataFrame:
    """The largest sale of every item, published only when a batch raises it."""
    tables = _new_tables(t)
    shipped = {"lineitem": _SLICE_OF.format("unix_micros(CAST(l_shipdate AS TIMESTAMP))")}

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        largest = reduce_by_key(OrderFeeds(arriving.stream, t.table).sale, "item_id", "quantity", "max")
        return keep(largest, tables, "largest", "item_id", checkpoint, only_changed=True, availableNow=True)

    _streamed(t, shipped, start)
    return tables.changes("largest").select("key", F.col("max_quantity").alias("value"), "batch_id")


def _bounded_windows(t: OrderTables) -> BoundedWindows:
    """Daily counts of events of which every tenth comes one slice late, every hundredth two."""
    events, work = event_stream(t.table("events")), _work_dir(t)
    log = BatchLog(t.spark, f"{work}/log")
    windows = BoundedWindows(log, events.schema, "event_type", "ts", "1 day", timedelta(days=2))
    for _ in _arrivals({"events": events}, {"events": _LATE_SLICE}, f"{work}/in"):
        live = t.spark.readStream.schema(events.schema).parquet(f"{work}/in/events.parquet")
        windows.keep(live, f"{work}/checkpoint", availableNow=True).awaitTermination()
    return windows


_LATE_SLICE = (
    f"least({_EVENT_SLICE} + CASE WHEN event_id % 100 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, {SLICES - 1})"
)


def stream_bounded_windows(t: OrderTables) -> DataFrame:
    return _windows(_bounded_windows(t).totals())


def stream_late_rows(t: OrderTables) -> DataFrame:
    """The events that came after their window was final."""
    late = _bounded_windows(t).late_rows()
    return late.select("event_id", "event_type", F.unix_millis("window_start").alias("window_start_ms"))


def _checked(t: OrderTables, rows: DataFrame, key: str, number: str, amounts: list[str]) -> DataFrame:
    """Both outputs of a live check: the numbers that passed, and the texts that did not with the reason."""
    work = _work_dir(t)
    feed = CheckedFeed(BatchLog(t.spark, f"{work}/log"), "feed", rows.schema, [number], amounts)
    for _ in _arrivals({"feed": rows}, {"feed": f"pmod(xxhash64({key}), {SLICES})"}, f"{work}/in"):
        live = t.spark.readStream.schema(rows.schema).parquet(f"{work}/in/feed.parquet")
        feed.keep(live, f"{work}/checkpoint", availableNow=True).awaitTermination()
    passed = feed.accepted().withColumnsRenamed({number: "value"})
    return passed.unionByName(feed.rejected().withColumnRenamed(number, "rejected"), allowMissingColumns=True)


def stream_page_numbers(t: OrderTables) -> DataFrame:
    segment = F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1)
    return _checked(t, t.table("pages").select("page_id", segment.alias("number")), "page_id", "number", [])


def stream_balances(t: OrderTables) -> DataFrame:
    balance = F.floor("c_acctbal").cast("bigint").cast("string")
    rows = t.table("customer").select(F.col("c_custkey").alias("customer_id"), balance.alias("quantity"))
    return _checked(t, rows, "customer_id", "quantity", ["quantity"])


def stream_reads_at_batch(t: OrderTables) -> DataFrame:
    """Stock by category and the items' categories, both as each batch left them."""
    tables, read = _totals_at_arrival(t), []
    for n in range(tables.last_common("category_totals", "item_latest") + 1):
        items = tables.view_at("item_latest", n).select("key", F.col("category_id").alias("value"))
        stock = tables.named("items-at-hand-per-cat-store", n)
        for name, rows in (("item_latest", items), ("items-at-hand-per-cat-store", stock)):
            read.append(rows.select(F.lit(n).cast("bigint").alias("batch_id"), F.lit(name).alias("name"), "key", "value"))
    return reduce(DataFrame.unionByName, read)


def stream_customer_names(t: OrderTables) -> DataFrame:
    """The store of customer names, which orders of every slice re-send."""
    tables = _new_tables(t)

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        feed = customer_changes(arriving.stream("customer"), arriving.stream("orders"), t.table("customer"))
        names = latest_names(feed, "customer_id")
        return keep(names, tables, "customer_latest", "customer_id", checkpoint, only_changed=True, availableNow=True)

    _streamed(t, _by_hash("customer", "orders"), start)
    return tables.named("customer-store")


def stream_category_names(t: OrderTables) -> DataFrame:
    """The store of category names, renamed by parts of every slice."""
    tables = _new_tables(t)

    def start(arriving: OrderTables, checkpoint: str) -> StreamingQuery:
        names = latest_names(category_changes(arriving.stream("part")), "category_id")
        return keep(names, tables, "category_latest", "category_id", checkpoint, only_changed=True, availableNow=True)

    _streamed(t, _by_hash("part"), start)
    return tables.named("category-store")


QUERIES: dict[str, Callable[[OrderTables], DataFrame]] = {
    "q1_replenished_by_item": _ledger(Ledger.replenished_by_item),
    "q2_sold_by_item": _ledger(Ledger.sold_by_item),
    "q3_returned_by_item": _ledger(Ledger.returned_by_item),
    "q4_sold_by_customer": _ledger(Ledger.sold_by_customer),
    "q5_returned_by_customer": _ledger(Ledger.returned_by_customer),
    "q6_replenished_by_category": _ledger(Ledger.replenished_by_category),
    "q7_sold_by_category": _ledger(Ledger.sold_by_category),
    "q8_returned_by_category": _ledger(Ledger.returned_by_category),
    "q9_items_at_hand": _ledger(Ledger.items_at_hand),
    "q10_items_with_customer": _ledger(Ledger.items_with_customer),
    "q11_items_at_hand_by_category": _ledger(Ledger.items_at_hand_by_category),
    "q6_as_wired": _ledger(Ledger.replenished_by_category_as_wired),
    "q8_as_wired": _ledger(Ledger.returned_by_category_as_wired),
    "q11_as_wired": _ledger(Ledger.items_at_hand_by_category_as_wired),
    "raw_replenished_by_item": _ledger(lambda g: g.raw_by_item("replenished")),
    "raw_sold_by_item": _ledger(lambda g: g.raw_by_item("sold")),
    "raw_returned_by_item": _ledger(lambda g: g.raw_by_item("returned")),
    "raw_sold_by_customer": _ledger(lambda g: g.raw_by_customer("sold")),
    "raw_returned_by_customer": _ledger(lambda g: g.raw_by_customer("returned")),
    "raw_replenished_by_category": _ledger(lambda g: g.raw_by_category("replenished")),
    "raw_sold_by_category": _ledger(lambda g: g.raw_by_category("sold")),
    "raw_returned_by_category": _ledger(lambda g: g.raw_by_category("returned")),
    "sold_minus_returned_no_spine": _ledger(Ledger.sold_minus_returned_no_spine),
    "stock_by_category_no_spine": _ledger(Ledger.stock_by_category_no_spine),
    "read_changes_count": read_changes_count,
    "incremental_pull": incremental_pull,
    "json_changes_sale": json_changes_sale,
    "changelog_changes": changelog_changes,
    "changelog_latest": changelog_latest,
    "published_topics": published_topics,
    "json_documents": items_json,
    "long_topic_records": long_topic_records,
    "rekey_sale_item": rekey_sale_item,
    "rekey_sale_customer": rekey_sale_customer,
    "parse_strict": parse_strict,
    "parse_accepts": parse_accepts,
    "parse_rejects": parse_rejects,
    "negative_rejects": negative_rejects,
    "non_negative_total": non_negative_total,
    "uppercase_lines": uppercase_lines,
    "original_and_upper": original_and_upper,
    "sale_snapshot_category": sale_snapshot_category,
    "asof_sale_by_category": asof_sale_by_category,
    "asof_sale_rows": asof_sale_rows,
    "asof_user_state": asof_user_state,
    "interval_left_join": interval_left,
    "interval_left_join_salted": interval_left_salted,
    "interval_left_sum": interval_sum,
    "item_latest": item_latest,
    "customer_latest": customer_latest,
    "category_latest": category_latest,
    "reduce_min_max": reduce_min_max,
    "reduce_latest": reduce_latest,
    "aggregate_sum": aggregate_sum,
    "signed_retract_sum": signed_retract_sum,
    "windowed_count_tumbling": windowed_count_tumbling,
    "windowed_count_hopping": windowed_count_hopping,
    "windowed_sum_hopping": windowed_sum_hopping,
    "lookup_by_key": lookup_by_key,
    "scan_all": scan_all,
    "key_range": key_range,
    "window_fetch": window_fetch,
    "stream_items_at_hand": stream_items_at_hand,
    "stream_items_with_customer": stream_items_with_customer,
    "stream_category_totals_at_arrival": stream_category_totals_at_arrival,
    "stream_category_rows": stream_category_rows,
    "stream_windowed_count": stream_windowed_count,
    "stream_window_fetch": stream_window_fetch,
    "stream_interval_left": stream_interval_left,
    "stream_interval_sum": stream_interval_sum,
    "stream_retracted_by_category": stream_retracted_by_category,
    "changelog_real_changes": changelog_real_changes,
    "stream_bounded_windows": stream_bounded_windows,
    "stream_late_rows": stream_late_rows,
    "stream_page_numbers": stream_page_numbers,
    "stream_balances": stream_balances,
    "stream_reads_at_batch": stream_reads_at_batch,
    "stream_customer_names": stream_customer_names,
    "stream_category_names": stream_category_names,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[OrderTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(OrderTables(spark, sf_dir))

        return run

    return {name: bind(build) for name, build in QUERIES.items()} | _llm_queries()


# The text operators and their pipeline, where their subpackage is there.


def _llm(of_queries: str, of_pipeline: str) -> dict:
    """What the subpackage and the pipeline register; nothing where the one or the other cannot be imported."""
    try:
        found = dict(getattr(importlib.import_module("stockledger.llm.queries"), of_queries))
    except ImportError:
        return {}
    try:
        of_all = getattr(importlib.import_module("corpus_pipeline"), of_pipeline)
    except ImportError:
        return found
    return found if of_all is None else found | {"pipeline": of_all}


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _llm("QUERIES", "run")


def _llm_oracles() -> dict[str, str]:
    return _llm("ORACLES", "ORACLE_SQL")


# The same questions in SQL, written as the join chains they are usually asked as.

_VIEWS = {
    "item": """SELECT p_partkey AS item_id, CAST(p_size AS BIGINT) AS category_id
        FROM part WHERE p_partkey % 50 <> 0""",
    "category": """SELECT CAST(g AS BIGINT) AS category_id, concat('CATEGORY_', g) AS name
        FROM (SELECT DISTINCT p_size AS g FROM part) x""",
    "cust": "SELECT c_custkey AS customer_id, c_name AS name FROM customer",
    "replenishment": """SELECT l_partkey AS item_id, CAST(l_quantity AS BIGINT) * 2 AS quantity
        FROM lineitem WHERE l_linenumber = 1 AND l_partkey % 7 <> 0""",
    "sale": """SELECT l_partkey AS item_id, o_custkey AS customer_id,
        CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ret": """SELECT l_partkey AS item_id, o_custkey AS customer_id,
        CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "item_changes": """SELECT p_partkey AS item_id, CAST(p_size AS BIGINT) AS category_id,
        CASE WHEN p_partkey % 11 = 0 THEN CAST('1996-01-01 00:00:00' AS TIMESTAMP)
             ELSE CAST('1990-01-01 00:00:00' AS TIMESTAMP) END AS ts, p_partkey * 2 AS seq
        FROM part WHERE p_partkey % 50 <> 0
        UNION ALL
        SELECT p_partkey, CAST(p_size % 50 + 1 AS BIGINT),
               CAST('1998-01-01 00:00:00' AS TIMESTAMP), p_partkey * 2 + 1
        FROM part WHERE p_partkey % 50 <> 0 AND p_partkey % 3 = 0""",
    "sale_ts": """SELECT l_partkey AS item_id, o_custkey AS customer_id,
        CAST(l_quantity AS BIGINT) AS quantity, CAST(l_shipdate AS TIMESTAMP) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ev": """SELECT event_id, ts, user_id, event_type,
        CAST(round(value * 100) AS BIGINT) AS cents FROM events""",
}


def _with(sql: str, **more: str) -> str:
    """The statement with all views, and any more it needs, in front."""
    views = {**_VIEWS, **more}
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in views.items())
    return f"WITH {ctes}\n{sql}"


def _filled_sql(spine: str, key: str, fact: str) -> str:
    return f"""SELECT s.{key}, CAST(COALESCE(a.q, 0) AS BIGINT) AS quantity FROM {spine} s
        LEFT JOIN (SELECT {key}, SUM(quantity) AS q FROM {fact} GROUP BY {key}) a
        ON s.{key} = a.{key}"""


def _raw_sql(key: str, fact: str) -> str:
    return f"SELECT {key}, CAST(SUM(quantity) AS BIGINT) AS quantity FROM {fact} GROUP BY {key}"


def _raw_category_sql(fact: str) -> str:
    return f"""SELECT COALESCE(i.category_id, 999999) AS category_id,
        CAST(SUM(f.quantity) AS BIGINT) AS quantity
        FROM {fact} f LEFT JOIN item i ON f.item_id = i.item_id GROUP BY 1"""


def _category_sql(fact: str) -> str:
    return f"""SELECT c.category_id, CAST(COALESCE(r.quantity, 0) AS BIGINT) AS quantity
        FROM category c LEFT JOIN ({_raw_category_sql(fact)}) r
        ON c.category_id = r.category_id"""


def _as_wired_sql(fact: str) -> str:
    return f"""SELECT c.customer_id AS category_id,
        CAST(COALESCE(r.quantity, 0) AS BIGINT) AS quantity
        FROM cust c LEFT JOIN ({_raw_category_sql(fact)}) r ON c.customer_id = r.category_id"""


def _combined_sql(key: str, first: str, *others: tuple[str, str]) -> str:
    terms = "".join(f" {sign} COALESCE(t{i}.quantity, 0)" for i, (sign, _) in enumerate(others))
    joins = "".join(
        f" LEFT JOIN ({sql}) t{i} ON t.{key} = t{i}.{key}" for i, (_, sql) in enumerate(others)
    )
    return f"SELECT t.{key}, CAST(t.quantity{terms} AS BIGINT) AS quantity FROM ({first}) t{joins}"


_HAND_SQL = _combined_sql(
    "item_id",
    _filled_sql("item", "item_id", "replenishment"),
    ("-", _filled_sql("item", "item_id", "sale")),
    ("+", _filled_sql("item", "item_id", "ret")),
)
_HELD_SQL = _combined_sql(
    "customer_id",
    _filled_sql("cust", "customer_id", "sale"),
    ("-", _filled_sql("cust", "customer_id", "ret")),
)
_CATEGORY_HAND_SQL = _combined_sql(
    "category_id",
    _category_sql("replenishment"),
    ("-", _category_sql("sale")),
    ("+", _category_sql("ret")),
)
_TOPICS = {
    "refill-qty-by-item": _filled_sql("item", "item_id", "replenishment"),
    "sale-qty-by-item": _filled_sql("item", "item_id", "sale"),
    "rets-qty-by-item": _filled_sql("item", "item_id", "ret"),
    "sale-qty-by-cust": _filled_sql("cust", "customer_id", "sale"),
    "rets-qty-by-cust": _filled_sql("cust", "customer_id", "ret"),
    "refill-qty-by-cat": _category_sql("replenishment"),
    "sale-qty-by-cat": _category_sql("sale"),
    "rets-qty-by-cat": _category_sql("ret"),
    "items-at-hand": _HAND_SQL,
    "items-with-cust": _HELD_SQL,
    "items-at-hand-per-cat": _CATEGORY_HAND_SQL,
}
_PAIRS_SQL = f"SELECT item_id AS key, quantity AS value FROM ({_HAND_SQL}) h"
_PAGE_NUMBERS = r"""SELECT page_id, regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS number
    FROM pages"""
_LONG_TEXT = "regexp_full_match(number, '[+-]?[0-9]+') AND TRY_CAST(number AS BIGINT) IS NOT NULL"
_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents"
# Full case mapping, as on the JVM: the upper case of sharp s is SS, not the capital letter.
_UPPER = "upper(replace(value, 'ß', 'ss'))"
_PAIRED = """FROM (SELECT * FROM ev WHERE event_type = 'click') l
    LEFT JOIN (SELECT * FROM ev WHERE event_type = 'purchase') r
    ON l.user_id = r.user_id AND r.ts >= l.ts - INTERVAL 50 MINUTE
    AND r.ts <= l.ts + INTERVAL 50 MINUTE"""
_INTERVAL = f"""SELECT l.user_id, l.event_id AS click_id, r.event_id AS purchase_id, r.cents
    {_PAIRED}"""
_ASOF = """FROM sale_ts f ASOF LEFT JOIN item_changes i
    ON f.item_id = i.item_id AND f.ts >= i.ts"""
_TIMED_FACTS = """SELECT 'r' AS kind, l_partkey AS item_id, l_shipdate AS ts,
        CAST(l_quantity AS BIGINT) * 2 AS quantity
        FROM lineitem WHERE l_linenumber = 1 AND l_partkey % 7 <> 0
    UNION ALL SELECT 's', item_id, ts, quantity FROM sale_ts
    UNION ALL SELECT 'b', l_partkey, l_shipdate, CAST(l_quantity AS BIGINT)
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""
_ARRIVED = f"""SELECT COALESCE(i.category_id, 999999) AS category_id,
    SUM(CASE WHEN f.kind = 'r' THEN f.quantity END) AS r,
    SUM(CASE WHEN f.kind = 's' THEN f.quantity END) AS s,
    SUM(CASE WHEN f.kind = 'b' THEN f.quantity END) AS b
    FROM ({_TIMED_FACTS}) f ASOF LEFT JOIN item_changes i
    ON f.item_id = i.item_id AND f.ts >= i.ts GROUP BY 1"""
_ASOF_STATE = """SELECT f.user_id, f.event_id, f.cents, c.held.s AS state
    FROM (SELECT nullif(user_id, 7) AS user_id, ts, event_id, cents
        FROM ev WHERE event_type = 'purchase') f
    ASOF LEFT JOIN (SELECT nullif(user_id, 7) AS user_id, ts,
        arg_max({'s': nullif(cents, cents % 3)}, event_id) AS held
        FROM ev WHERE event_type <> 'purchase' GROUP BY 1, 2) c
    ON f.user_id = c.user_id AND f.ts >= c.ts"""
_ASOF_TOTALS = f"""SELECT COALESCE(i.category_id, 999999) AS category_id,
    CAST(SUM(f.quantity) AS BIGINT) AS quantity {_ASOF} GROUP BY 1"""
_ASOF_ROWS = f"""SELECT f.item_id, f.customer_id, f.quantity,
    COALESCE(i.category_id, 999999) AS category_id {_ASOF}"""


def _windows_sql(total: str, days: int) -> str:
    """Windows of ``days`` days starting every day, so an event is in ``days`` of them."""
    return f"""SELECT event_type,
        epoch_ms(date_trunc('day', ts) - back * INTERVAL 1 DAY) AS window_start_ms,
        CAST({total} AS BIGINT) AS total
        FROM ev, (SELECT unnest(range({days})) AS back) b GROUP BY 1, 2"""


def _shipped_slice(ts: str) -> str:
    return f"""CASE WHEN {ts} < '1994-01-01' THEN 0 WHEN {ts} < '1996-01-01' THEN 1
        WHEN {ts} < '1998-01-01' THEN 2 ELSE 3 END"""


def _regrouped_sql(n: int) -> str:
    """Sold by category over the items and sales of slices 0 to n."""
    return f"""SELECT CAST({n} AS BIGINT) AS batch_id, COALESCE(i.category_id, 999999) AS category_id,
        CAST(SUM(COALESCE(s.q, 0)) AS BIGINT) AS quantity, COUNT(*) AS members
        FROM (SELECT item_id, arg_max(category_id, ts) AS category_id FROM item_changes
            WHERE {_shipped_slice("ts")} <= {n} GROUP BY 1) i
        FULL JOIN (SELECT item_id, SUM(quantity) AS q FROM sale_ts WHERE {_shipped_slice("ts")} <= {n} GROUP BY 1) s
        ON s.item_id = i.item_id GROUP BY 2"""


def _at_batch_sql(n: int) -> str:
    """Items and stock by category after slice n."""
    return f"""SELECT CAST({n} AS BIGINT) AS batch_id, 'item_latest' AS name, item_id AS key, arg_max(category_id, ts) AS value
        FROM item_changes WHERE {_shipped_slice("ts")} <= {n} GROUP BY item_id
    UNION ALL SELECT {n}, 'items-at-hand-per-cat-store', c.category_id, CAST(COALESCE(a.q, 0) AS BIGINT)
        FROM category c LEFT JOIN (SELECT COALESCE(i.category_id, 999999) AS category_id,
            SUM(CASE WHEN f.kind = 's' THEN -f.quantity ELSE f.quantity END) AS q
            FROM (SELECT * FROM ({_TIMED_FACTS}) x WHERE {_shipped_slice("ts")} <= {n}) f
            ASOF LEFT JOIN item_changes i ON f.item_id = i.item_id AND f.ts >= i.ts GROUP BY 1) a
        ON c.category_id = a.category_id"""


# Events in the slices they arrive in, with the end of their day and whether it was final when they came.
_LATE_EVENTS = f"""placed AS (SELECT *, date_trunc('day', ts) AS day, {_LATE_SLICE} AS slice FROM ev),
    clock AS (SELECT s.slice, MAX(p.ts) - INTERVAL 2 DAY AS cut
        FROM (SELECT DISTINCT slice FROM placed) s JOIN placed p ON p.slice < s.slice GROUP BY 1),
    judged AS (SELECT p.*, COALESCE(p.day + INTERVAL 1 DAY <= c.cut, false) AS late
        FROM placed p LEFT JOIN clock c ON c.slice = p.slice)"""


def _checked_sql(key: str, number: str, ok: str, reason: str, rows: str) -> str:
    return f"""SELECT {key}, CASE WHEN {ok} THEN CAST({number} AS BIGINT) END AS value,
        CASE WHEN NOT ({ok}) THEN {number} END AS rejected, CASE WHEN NOT ({ok}) THEN '{reason}' END AS reason
        FROM ({rows}) x"""


def _latest_sql(key: str, value: str, changes: str) -> str:
    return f"SELECT {key}, arg_max({value}, seq) AS {value} FROM ({changes}) c GROUP BY {key}"


_CUSTOMER_LATEST = _latest_sql(
    "customer_id",
    "name",
    """SELECT c_custkey AS customer_id, c_name AS name, -1 AS seq FROM customer
    UNION ALL SELECT c_custkey, concat(c_name, ' ', o_orderpriority), o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
_CATEGORY_LATEST = _latest_sql(
    "category_id",
    "name",
    "SELECT CAST(p_size AS BIGINT) AS category_id, p_name AS name, p_partkey AS seq FROM part",
)

ORACLES = {
    "q1_replenished_by_item": _with(_filled_sql("item", "item_id", "replenishment")),
    "q2_sold_by_item": _with(_filled_sql("item", "item_id", "sale")),
    "q3_returned_by_item": _with(_filled_sql("item", "item_id", "ret")),
    "q4_sold_by_customer": _with(_filled_sql("cust", "customer_id", "sale")),
    "q5_returned_by_customer": _with(_filled_sql("cust", "customer_id", "ret")),
    "q6_replenished_by_category": _with(_category_sql("replenishment")),
    "q7_sold_by_category": _with(_category_sql("sale")),
    "q8_returned_by_category": _with(_category_sql("ret")),
    "q9_items_at_hand": _with(_HAND_SQL),
    "q10_items_with_customer": _with(_HELD_SQL),
    "q11_items_at_hand_by_category": _with(_CATEGORY_HAND_SQL),
    "q6_as_wired": _with(_as_wired_sql("replenishment")),
    "q8_as_wired": _with(_as_wired_sql("ret")),
    "q11_as_wired": _with(
        _combined_sql(
            "category_id",
            _as_wired_sql("replenishment"),
            ("-", _category_sql("sale")),
            ("+", _as_wired_sql("ret")),
        )
    ),
    "raw_replenished_by_item": _with(_raw_sql("item_id", "replenishment")),
    "raw_sold_by_item": _with(_raw_sql("item_id", "sale")),
    "raw_returned_by_item": _with(_raw_sql("item_id", "ret")),
    "raw_sold_by_customer": _with(_raw_sql("customer_id", "sale")),
    "raw_returned_by_customer": _with(_raw_sql("customer_id", "ret")),
    "raw_replenished_by_category": _with(_raw_category_sql("replenishment")),
    "raw_sold_by_category": _with(_raw_category_sql("sale")),
    "raw_returned_by_category": _with(_raw_category_sql("ret")),
    "sold_minus_returned_no_spine": _with(
        _combined_sql(
            "customer_id", _raw_sql("customer_id", "sale"), ("-", _raw_sql("customer_id", "ret"))
        )
    ),
    "stock_by_category_no_spine": _with(
        _combined_sql(
            "category_id",
            _raw_category_sql("replenishment"),
            ("+", _raw_category_sql("ret")),
            ("-", _raw_category_sql("sale")),
        )
    ),
    "read_changes_count": _with(
        " UNION ALL ".join(
            f"SELECT '{feed}' AS feed, COUNT(*) AS records FROM {view}"
            for feed, view in (
                ("item", "item"),
                ("customer", "cust"),
                ("category", "category"),
                ("replenishment", "replenishment"),
                ("sale", "sale"),
                ("return", "ret"),
            )
        )
    ),
    "incremental_pull": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderkey > (SELECT MAX(o_orderkey) FROM orders WHERE o_orderdate < '1995-01-03')""",
    "json_changes_sale": _with(_raw_sql("item_id", "sale")),
    "changelog_changes": _with(
        """SELECT item_id AS key, CAST(SUM(q) OVER (PARTITION BY item_id ORDER BY batch_id)
            AS BIGINT) AS value, batch_id
        FROM (SELECT item_id, CASE WHEN ts < '1994-01-01' THEN 0 WHEN ts < '1996-01-01' THEN 1
            WHEN ts < '1998-01-01' THEN 2 ELSE 3 END::BIGINT AS batch_id, SUM(quantity) AS q
            FROM sale_ts GROUP BY 1, 2)"""
    ),
    "changelog_latest": _with(
        "SELECT item_id AS key, CAST(SUM(quantity) AS BIGINT) AS value FROM sale_ts GROUP BY 1"
    ),
    "published_topics": _with(
        " UNION ALL ".join(
            f"SELECT '{name}-topic' AS topic, * FROM ({sql}) t(key, value)"
            for name, sql in _TOPICS.items()
        )
    ),
    "json_documents": _with(
        f"""SELECT concat('{{"key":', key, ',"value":', value, '}}') AS document
        FROM ({_PAIRS_SQL}) p"""
    ),
    "long_topic_records": _with(
        f"""SELECT upper(printf('%016x', key)) AS key_hex, upper(printf('%016x', value))
        AS value_hex, key, value FROM ({_PAIRS_SQL}) p"""
    ),
    "rekey_sale_item": _with("SELECT item_id AS key, quantity AS value FROM sale"),
    "rekey_sale_customer": _with("SELECT customer_id AS key, quantity AS value FROM sale"),
    "parse_strict": """SELECT user_id AS key,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events""",
    "parse_accepts": f"""SELECT page_id, CAST(number AS BIGINT) AS number
        FROM ({_PAGE_NUMBERS}) p WHERE {_LONG_TEXT}""",
    "parse_rejects": f"SELECT page_id, number FROM ({_PAGE_NUMBERS}) p WHERE NOT ({_LONG_TEXT})",
    "negative_rejects": """SELECT c_custkey AS customer_id,
        CAST(floor(c_acctbal) AS BIGINT) AS quantity FROM customer WHERE floor(c_acctbal) < 0""",
    "non_negative_total": """SELECT CAST(SUM(CAST(floor(c_acctbal) AS BIGINT)) AS BIGINT)
        AS quantity, COUNT(*) AS n FROM customer WHERE floor(c_acctbal) >= 0""",
    "uppercase_lines": f"SELECT doc_id, {_UPPER} AS value FROM ({_LINES}) x",
    "original_and_upper": f"SELECT value, {_UPPER} AS upper_value FROM ({_LINES}) x",
    "sale_snapshot_category": _with(
        f"""SELECT s.item_id, s.customer_id, s.quantity,
            COALESCE(i.category_id, 999999) AS category_id
        FROM sale s LEFT JOIN ({_latest_sql("item_id", "category_id", _VIEWS["item_changes"])}) i
        ON s.item_id = i.item_id"""
    ),
    "asof_sale_by_category": _with(_ASOF_TOTALS),
    "asof_sale_rows": _with(_ASOF_ROWS),
    "asof_user_state": _with(_ASOF_STATE),
    "interval_left_join": _with(_INTERVAL),
    "interval_left_join_salted": _with(_INTERVAL),
    "interval_left_sum": _with(
        f"""SELECT l.user_id, CAST(SUM(COALESCE(r.cents, 0)) AS BIGINT) AS cents
        {_PAIRED} GROUP BY 1"""
    ),
    "item_latest": _latest_sql("item_id", "category_id", _VIEWS["item_changes"]),
    "customer_latest": _CUSTOMER_LATEST,
    "category_latest": _CATEGORY_LATEST,
    "reduce_min_max": _with(
        """SELECT customer_id, MIN(quantity) AS min_quantity, MAX(quantity) AS max_quantity,
        CAST(SUM(quantity) AS BIGINT) AS sum_quantity FROM sale GROUP BY 1"""
    ),
    "reduce_latest": """SELECT o_custkey AS customer_id,
        arg_max(o_orderstatus, o_orderkey) AS latest_status FROM orders GROUP BY 1""",
    "aggregate_sum": _with(_raw_sql("customer_id", "ret")),
    "signed_retract_sum": _with(
        """SELECT item_id, CAST(SUM(q) AS BIGINT) AS quantity FROM (
            SELECT item_id, quantity AS q FROM sale
            UNION ALL SELECT item_id, -quantity FROM ret) x GROUP BY 1"""
    ),
    "windowed_count_tumbling": _with(_windows_sql("COUNT(*)", 1)),
    "windowed_count_hopping": _with(_windows_sql("COUNT(*)", 2)),
    "windowed_sum_hopping": _with(_windows_sql("SUM(cents)", 2)),
    "lookup_by_key": _with(f"SELECT * FROM ({_PAIRS_SQL}) p WHERE key = 42"),
    "scan_all": _with(_PAIRS_SQL),
    "key_range": _with(f"SELECT * FROM ({_PAIRS_SQL}) p WHERE key BETWEEN 100 AND 1500"),
    "window_fetch": _with(
        f"""SELECT window_start_ms AS key, total AS value FROM ({_windows_sql("COUNT(*)", 1)}) w
        WHERE event_type = 'click' AND window_start_ms BETWEEN 1704153600000 AND 1705276800000"""
    ),
    "stream_items_at_hand": _with(_PAIRS_SQL),
    "stream_items_with_customer": _with(
        f"SELECT customer_id AS key, quantity AS value FROM ({_HELD_SQL}) h"
    ),
    "stream_category_totals_at_arrival": _with(
        " UNION ALL ".join(
            [
                f"""SELECT '{name}-store' AS name, c.category_id AS key,
                CAST(COALESCE({value}, 0) AS BIGINT) AS value
                FROM category c LEFT JOIN arrived a ON c.category_id = a.category_id"""
                for name, value in (
                    ("refill-qty-by-cat", "r"),
                    ("sale-qty-by-cat", "s"),
                    ("rets-qty-by-cat", "b"),
                    ("items-at-hand-per-cat", "COALESCE(r, 0) - COALESCE(s, 0) + COALESCE(b, 0)"),
                )
            ]
            + [
                f"""SELECT '{name}-store-0.8', category_id, CAST({value} AS BIGINT)
                FROM arrived WHERE {value} IS NOT NULL"""
                for name, value in (
                    ("refill-qty-by-cat", "r"),
                    ("sale-qty-by-cat", "s"),
                    ("rets-qty-by-cat", "b"),
                )
            ]
        ),
        arrived=_ARRIVED,
    ),
    "stream_category_rows": _with(
        f"SELECT COALESCE(i.category_id, 999999) AS category_id, 'sold' AS kind, f.quantity {_ASOF}"
    ),
    "stream_windowed_count": _with(_windows_sql("COUNT(*)", 2)),
    "stream_window_fetch": _with(
        f"""SELECT window_start_ms AS key, total AS value FROM ({_windows_sql("COUNT(*)", 1)}) w
        WHERE event_type = 'click' AND window_start_ms BETWEEN 1704153600000 AND 1705276800000"""
    ),
    "stream_interval_left": _with(_INTERVAL),
    "stream_interval_sum": _with(
        f"""SELECT l.user_id, CAST(SUM(COALESCE(r.cents, 0)) AS BIGINT) AS cents
        {_PAIRED} GROUP BY 1"""
    ),
    "stream_retracted_by_category": _with(" UNION ALL ".join(_regrouped_sql(n) for n in range(SLICES))),
    "changelog_real_changes": _with(
        f"""SELECT key, CAST(so_far AS BIGINT) AS value, CAST(batch_id AS BIGINT) AS batch_id
        FROM (SELECT *, lag(so_far) OVER (PARTITION BY key ORDER BY batch_id) AS before
            FROM (SELECT key, batch_id, MAX(q) OVER (PARTITION BY key ORDER BY batch_id) AS so_far
                FROM (SELECT item_id AS key, {_shipped_slice("ts")} AS batch_id, MAX(quantity) AS q
                    FROM sale_ts GROUP BY 1, 2)))
        WHERE before IS NULL OR so_far > before"""
    ),
    "stream_bounded_windows": _with(
        f"""SELECT event_type, epoch_ms(day) AS window_start_ms, COUNT(*) AS total
        FROM (WITH {_LATE_EVENTS} SELECT * FROM judged) WHERE NOT late GROUP BY 1, 2"""
    ),
    "stream_late_rows": _with(
        f"""SELECT event_id, event_type, epoch_ms(day) AS window_start_ms
        FROM (WITH {_LATE_EVENTS} SELECT * FROM judged) WHERE late"""
    ),
    "stream_page_numbers": _checked_sql("page_id", "number", _LONG_TEXT, "unparsable: number", _PAGE_NUMBERS),
    "stream_balances": _checked_sql(
        "customer_id", "quantity", "CAST(quantity AS BIGINT) >= 0", "negative: quantity",
        "SELECT c_custkey AS customer_id, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS quantity FROM customer",
    ),
    "stream_reads_at_batch": _with(" UNION ALL ".join(_at_batch_sql(n) for n in range(SLICES))),
    "stream_customer_names": f"SELECT customer_id AS key, name AS value FROM ({_CUSTOMER_LATEST}) x",
    "stream_category_names": f"SELECT category_id AS key, name AS value FROM ({_CATEGORY_LATEST}) x",
}


def oracle_sql() -> dict[str, str]:
    return ORACLES | _llm_oracles()
