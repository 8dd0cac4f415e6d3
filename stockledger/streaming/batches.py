"""Category lookup at arrival without keyed Python state, a micro-batch at a time: totals, or the facts themselves.

Each batch looks its facts up in the item changes of the same batch and in the
items kept before it, with the batch as-of join. ``keep_category_totals`` adds the sums to kept
totals, ``keep_category_rows`` appends the looked-up facts to a log. All of it is joins and
aggregates over whole batches: no task takes an item's facts into memory, hot items included, so these are the forms
for large feeds; ``category_at_arrival`` hands the facts on as a streaming DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockledger.functions import non_negative, required
from stockledger.operators.keyed import latest_by_key
from stockledger.operators.lookup import asof_lookup, asof_totals
from stockledger.plans.feeds import KINDS, Feeds
from stockledger.schemas import UNKNOWN_CATEGORY
from stockledger.sources.kept import BatchLog, KeptTables

ITEMS = "item_latest"
TOTALS = "category_totals"

# Arrival number of what was known before a batch: below all others, with room to count down.
BEFORE_ALL = -(2**62)

_ITEM_ROW = "key bigint, category_id bigint, seq bigint"
_TOTAL_ROW = "key bigint, seq bigint, " + ", ".join(f"{k} bigint" for k in KINDS)


def keep_category_totals(
    feeds: Feeds,
    tables: KeptTables,
    checkpoint: str,
    order: str = "seq",
    bucket: int = 1_000_000,
    **trigger,
) -> StreamingQuery:
    """Keep ``category_totals`` up to date from streaming feeds.

    ``order`` must be comparable across the feeds, see ``category_at_arrival``;
    ``bucket`` is how many of its units the as-of join treats as one piece. The item table
    kept along the way is ``item_latest``. A batch is read once for each of the two tables it
    changes and nothing is cached; bound it with maxFilesPerTrigger or the like on the sources.
    """
    facts = dict(zip(KINDS, (feeds.replenishment, feeds.sale, feeds.ret), strict=True))
    seq = F.col(order).cast("bigint").alias("seq")
    rows = [
        df.select(F.lit(kind).alias("kind"), required("item_id", "item_id").alias("item_id"), required("quantity").alias("quantity"), seq)
        for kind, df in facts.items()
    ]
    item = feeds.item.select(F.lit("item").alias("kind"), "item_id", "category_id", seq)
    category = feeds.category.select(F.lit("category").alias("kind"), "category_id", seq)
    records = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [*rows, item, category]
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        _add(batch, batch_id, tables, bucket)

    return (
        records.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def keep_category_rows(
    facts: DataFrame,
    item_changes: DataFrame,
    tables: KeptTables,
    log: BatchLog,
    name: str,
    checkpoint: str,
    order: str = "seq",
    bucket: int = 1_000_000,
    **trigger,
) -> StreamingQuery:
    """Append (category_id, kind, quantity) of every fact to a log, the category as its item had it when the fact came.

    ``facts`` is (item_id, kind, quantity, <order>), ``item_changes`` (item_id, category_id, <order>), see
    :func:`keep_category_totals`. Facts meet their category by an equality join on (item, instant), in which adaptive execution
    splits what is hot, and the instants are distinct before anything orders them.
    """
    seq = F.col(order).cast("bigint").alias("seq")
    items = item_changes.select("item_id", required("category_id", "category_id").alias("category_id"), seq)
    mine = facts.select("item_id", "kind", required("quantity", "quantity").alias("quantity"), seq)
    records = mine.withColumn("fact", F.lit(True)).unionByName(items, allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        found = batch.where("fact").select("item_id", "kind", "quantity", "seq")
        changes = batch.where("fact IS NULL").select("item_id", "category_id", "seq")
        versions = changes.unionByName(_known(tables, batch_id, found))
        looked_up = asof_lookup(
            found, versions, "item_id", "category_id", UNKNOWN_CATEGORY, ts="seq", bucket=bucket
        )
        log.write(name, looked_up.select("category_id", "kind", "quantity"), batch_id)
        tables.publish(ITEMS, _newest(changes), batch_id)

    return (
        records.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def _known(tables: KeptTables, batch_id: int, facts: DataFrame) -> DataFrame:
    """The items kept before a batch as versions before all others; only those the batch has facts of."""
    return (
        tables.view_before(ITEMS, batch_id, _ITEM_ROW)
        .select(F.col("key").alias("item_id"), "category_id")
        .join(facts.select("item_id").distinct(), "item_id", "left_semi")
        .withColumn("seq", F.lit(BEFORE_ALL).cast("bigint"))
    )


def _newest(changes: DataFrame) -> DataFrame:
    """A batch's last version of every item it changes, as rows of the kept table."""
    newest = latest_by_key(changes.withColumn("at", F.col("seq")), "item_id", ["category_id", "at"])
    return newest.select(F.col("item_id").alias("key"), "category_id", F.col("at").alias("seq"))


def _add(batch: DataFrame, batch_id: int, tables: KeptTables, bucket: int) -> None:
    """Both tables are read as they were before this batch, so repeating it changes nothing."""
    changes = batch.where("kind = 'item'").select("item_id", "category_id", "seq")
    checked = non_negative("quantity")
    facts = batch.where(F.col("kind").isin(*KINDS)).select(
        "item_id", "seq", *[F.when(F.col("kind") == k, checked).alias(k) for k in KINDS]
    )
    versions = changes.unionByName(_known(tables, batch_id, facts))
    sums = asof_totals(
        facts,
        versions,
        "item_id",
        "category_id",
        list(KINDS),
        UNKNOWN_CATEGORY,
        ts="seq",
        bucket=bucket,
    )

    before = tables.view_before(TOTALS, batch_id, _TOTAL_ROW)
    added = sums.withColumnRenamed("category_id", "key").withColumn("changed", F.lit(True))
    marks = batch.where("kind = 'category'").select(
        F.col("category_id").alias("key"), "seq", F.lit(True).alias("changed")
    )
    totals = (
        before.unionByName(added, allowMissingColumns=True)
        .unionByName(marks, allowMissingColumns=True)
        .groupBy("key")
        .agg(
            F.max("seq").alias("seq"),
            *[F.sum(k).alias(k) for k in KINDS],
            F.max("changed").alias("changed"),
        )
        .where("changed")
        .drop("changed")
    )
    tables.publish(TOTALS, totals, batch_id)
    tables.publish(ITEMS, _newest(changes), batch_id)
