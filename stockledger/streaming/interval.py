"""The interval left join of two live feeds, and the running sum per key of what it finds.

The join is Spark's stream-stream outer join under two watermarks: a right row may come long after its left row, and a
left row without a match is let go once the watermark has passed its reach. Joined rows are written batch by batch,
and a batch's sums are taken from what it wrote, so the join's state is read once.

Where only the sums are wanted, ``keep_interval_left_sums`` makes no pairs and holds no join state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockledger.functions import zero_fill
from stockledger.operators.interval import REACH, interval_left_join, interval_left_sum
from stockledger.sources.kept import BatchLog, KeptTables
from stockledger.streaming.kept import add_to_kept
from stockledger.streaming.state import use_rocksdb


def keep_interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    log: BatchLog,
    name: str,
    checkpoint: str,
    late: str,
    ts: str = "ts",
    reach: timedelta = REACH,
    salts: int = 1,
    then: Callable[[DataFrame, int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Append the rows of ``interval_left_join`` to a log as they become final.

    ``late`` is how far rows of either feed may lag behind its newest one; of the two feeds the slower one sets the pace. ``then`` is given
    every batch's rows as they were written.
    """
    use_rocksdb(log.spark)
    joined = interval_left_join(left, right, key, ts, reach, late, salts)
    schema = joined.schema

    def write(rows: DataFrame, batch_id: int) -> None:
        log.write(name, rows, batch_id)
        if then:
            then(log.batch(name, batch_id, schema), batch_id)

    return (
        joined.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def keep_interval_sums(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    log: BatchLog,
    tables: KeptTables,
    name: str,
    checkpoint: str,
    late: str,
    before: datetime | None = None,
    **more,
) -> StreamingQuery:
    """Keep per left key the running sum of the matched ``value``, zero while nothing matched.

    Left rows from the instant ``before`` on are not counted: it is where a finite feed's closing rows stand.
    """
    ts = more.get("ts", "ts")

    def add(rows: DataFrame, batch_id: int) -> None:
        known = rows if before is None else rows.where(F.col(ts) < F.lit(before))
        found = known.select(F.col(key).alias("key"), zero_fill(f"right_{value}").alias(value))
        add_to_kept(tables, name, found, batch_id)

    return keep_interval_join(left, right, key, log, name, checkpoint, late, then=add, **more)


def keep_interval_left_sums(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    log: BatchLog,
    tables: KeptTables,
    name: str,
    checkpoint: str,
    late: timedelta,
    ts: str = "ts",
    reach: timedelta = REACH,
    **trigger,
) -> StreamingQuery:
    """The sums of :func:`keep_interval_sums` without the pairs: a key's sum is kept from its first left row on, zero until something matches.

    A batch adds what its left rows meet among all right rows still open, and what earlier left rows meet among its right rows, both
    by ``interval_left_sum``, so the work is linear however dense a key is. Rows still open are written with the batch. As with Spark's watermarks
    the clock is the newest time of the slower feed less ``late``: rows up to it come too late and count nowhere, rows more than the
    reach behind it are let go, and rows without a time, or right rows without a key, do not count.
    """
    both = _side(left, key, ts, F.lit(None), True).unionByName(_side(right.where(F.col(key).isNotNull()), key, ts, F.col(value), False))
    kept, added = f"{name}_open", f"{name}_added"
    schema = T.StructType([*both.schema, T.StructField("fresh", T.BooleanType())])
    sums = T.StructType([T.StructField("key", both.schema["key"].dataType), T.StructField(value, T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        before = log.batch(kept, batch_id - 1, schema).drop("fresh")
        newest = [r["newest"] for r in before.groupBy("mine").agg(F.max(F.unix_micros("ts")).alias("newest")).take(2)]
        rows = batch.where(F.col("ts").isNotNull())
        if len(newest) == 2:  # no clock before both feeds have a row
            clock = F.timestamp_micros(F.lit(min(newest))) - late
            rows, before = rows.where(F.col("ts") > clock), before.where(F.col("ts") >= clock - reach)
        marked = rows.withColumn("fresh", F.lit(True)).unionByName(before.withColumn("fresh", F.lit(False)))
        log.write(kept, marked, batch_id)

        now = log.batch(kept, batch_id, schema)
        found = interval_left_sum(now.where("mine AND fresh"), now.where("NOT mine"), "key", "value", reach=reach)
        more = interval_left_sum(now.where("mine AND NOT fresh"), now.where("NOT mine AND fresh"), "key", "value", reach=reach)
        log.write(added, found.unionByName(more.where("value <> 0")).withColumnRenamed("value", value), batch_id)
        add_to_kept(tables, name, log.batch(added, batch_id, sums), batch_id)

    return (
        both.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def _side(feed: DataFrame, key: str, ts: str, value: Column, mine: bool) -> DataFrame:
    return feed.select(
        F.col(key).alias("key"), F.col(ts).alias("ts"), value.cast("bigint").alias("value"), F.lit(mine).alias("mine")
    )


def closing_row(feed: DataFrame, at: datetime, key: str, unused: int | str, ts: str = "ts") -> DataFrame:
    """One row of the feed's columns at an instant beyond all others, under a key no row has, the rest null.

    At the end of a finite feed it moves the watermark over everything that is still held. The key must not be null: rows that
    cannot match are dropped before the watermark sees them.
    """
    filled = {ts: F.lit(at), key: F.lit(unused)}
    columns = [filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in feed.schema]
    return feed.sparkSession.range(1).select(*columns)
