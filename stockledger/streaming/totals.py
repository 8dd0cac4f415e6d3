"""Totals kept up to date from streams.

``Ledger(feeds).item_totals()`` (with ``attributes=["category_id"]`` where the latest
category is to be kept too) and ``customer_totals()`` run as they are on
streaming feeds: one union and one update-mode aggregate. By-category totals need
the category of each fact first, which is the keyed state of ``category_at_arrival``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockledger.functions import non_negative
from stockledger.operators.spine import spine_totals
from stockledger.plans.feeds import KINDS, Feeds
from stockledger.sources.kept import KeptTables
from stockledger.streaming.arrival import category_at_arrival
from stockledger.streaming.state import use_rocksdb


def keep(
    rows: DataFrame,
    tables: KeptTables,
    table: str,
    key: str,
    checkpoint: str,
    only_changed: bool = False,
    then: Callable[[int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep a streaming total as a table, its key column renamed to ``key``.

    ``only_changed`` publishes no row that is as it was kept; ``then`` is called with the number of every batch published.
    """
    use_rocksdb(tables.spark)
    publish = tables.writer(table, only_changed)

    def write(changes: DataFrame, batch_id: int) -> None:
        publish(changes, batch_id)
        if then:
            then(batch_id)

    return (
        rows.withColumnRenamed(key, "key")
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def keep_windows(
    windows: DataFrame, tables: KeptTables, table: str, key: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Keep a streaming ``windowed_total`` as a table, read back with ``tables.windows``."""
    keyed = windows.select(
        F.struct(F.col(key).alias("of"), "window_start").alias("key"), "window_end", "total"
    )
    return keep(keyed, tables, table, "key", checkpoint, **trigger)


def category_totals_at_arrival(feeds: Feeds, order: str = "seq", salts: int = 8) -> DataFrame:
    """By-category totals of streaming feeds, each fact under its category at arrival."""
    sources = dict(zip(KINDS, (feeds.replenishment, feeds.sale, feeds.ret), strict=True))
    facts = [
        df.select("item_id", F.lit(kind).alias("kind"), "quantity", order)
        for kind, df in sources.items()
    ]
    looked_up = category_at_arrival(reduce(DataFrame.unionByName, facts), feeds.item, order, salts)
    checked = non_negative("quantity")
    moves = looked_up.select(
        "category_id", *[F.when(F.col("kind") == k, checked).alias(k) for k in KINDS]
    )
    return spine_totals(feeds.category, moves, "category_id", KINDS)


def latest_names(feed: DataFrame, key: str) -> DataFrame:
    """Latest name per key of a customer or category feed, with the arrival order it came at."""
    return feed.groupBy(key).agg(F.max_by("name", "seq").alias("name"), F.max("seq").alias("seq"))
