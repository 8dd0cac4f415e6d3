"""Left joins of two timed inputs whose times lie within a reach of each other.

Both sides are cut into buckets as wide as the reach. A right row is copied into
its own bucket and the two beside it, a left row stays in its own, so every pair
within reach meets exactly once on an equality of (key, bucket): no range join,
and a hot key is spread over time. What is hot inside one bucket is left to
adaptive execution in batch, or to ``salts`` in a stream.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.schemas import JOIN_REACH_MINUTES

REACH = timedelta(minutes=JOIN_REACH_MINUTES)


def _micros(reach: timedelta) -> int:
    return int(reach.total_seconds() * 1_000_000)


def _at(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _bucket(at: Column, reach: timedelta) -> Column:
    width = _micros(reach)
    return F.call_function("div", at, F.lit(width)) - F.when(at % width < 0, 1).otherwise(0)


def _beside(bucket: Column) -> Column:
    return F.explode(F.sequence(bucket - 1, bucket + 1))


def interval_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str = "ts",
    reach: timedelta = REACH,
    late: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """left ⟕ right on the key and |left.ts - right.ts| <= reach, ends included.

    Right columns come back as ``right_<name>``. Streams need ``late``, the
    watermark of both sides; a left row without a match is then held until the
    watermark has passed it. ``salts`` splits every (key, bucket) that many ways,
    at the price of that many copies of the right side. In batch a row's salt goes by its place, so equal rows spread; in a
    stream it is a hash of the row. A task that is run again deals its rows out alike.
    """
    if clash := {f"right_{c}" for c in right.columns} & set(left.columns):
        raise ValueError(f"left columns that would be hidden: {sorted(clash)}")
    if late is not None:
        left, right = left.withWatermark(ts, late), right.withWatermark(ts, late)
    mine = left.withColumn("__bucket", _bucket(_at(ts), reach))
    theirs = right.select(
        *[F.col(c).alias(f"right_{c}") for c in right.columns],
        _beside(_bucket(_at(ts), reach)).alias("__right_bucket"),
    )
    together = (F.col(key) == F.col(f"right_{key}")) & (F.col("__bucket") == F.col("__right_bucket"))
    if salts > 1:
        place = F.xxhash64(*left.columns) if left.isStreaming else F.monotonically_increasing_id()
        salt = F.pmod(place, F.lit(salts)).cast("int")
        mine = mine.withColumn("__salt", salt)
        theirs = theirs.withColumn("__right_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        together = together & (F.col("__salt") == F.col("__right_salt"))
    # A literal: the check for stream joins reads the range before constants are folded.
    span = F.expr(f"INTERVAL '{reach.total_seconds():.6f}' SECOND")
    near = (F.col(f"right_{ts}") >= F.col(ts) - span) & (F.col(f"right_{ts}") <= F.col(ts) + span)
    return mine.join(theirs, together & near, "left").drop(
        "__bucket", "__right_bucket", "__salt", "__right_salt"
    )


def interval_left_sum(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    ts: str = "ts",
    reach: timedelta = REACH,
) -> DataFrame:
    """Per left key, the sum of ``value`` over all pairs of :func:`interval_left_join`.

    Zero for keys without a pair, the null key among them. The pairs are never made: a left row adds the
    running sum of the right side at the end of its reach and takes back the one
    before its start, so the work is linear however dense a key is.
    """
    at, width = F.col("at"), _micros(reach)
    lefts = left.select(key, _at(ts).alias("at"))
    lefts = lefts.withColumn("bucket", _bucket(at, reach))
    start = lefts.select(key, "bucket", (at - width).alias("at"), _rank(0), _times(-1), _none())
    end = lefts.select(key, "bucket", (at + width).alias("at"), _rank(2), _times(1), _none())
    rights = right.where(F.col(key).isNotNull()).select(key, _at(ts).alias("at"), F.col(value).alias("added"))
    rights = rights.select(
        key, _beside(_bucket(at, reach)).alias("bucket"), "at", _rank(1), _times(0), "added"
    )
    # One row per instant before the exchange; at one instant a start comes
    # before the right rows and an end after them, which makes both ends inclusive.
    instants = (
        rights.unionByName(start)
        .unionByName(end)
        .groupBy(key, "bucket", "at", "rank")
        .agg(F.sum("times").alias("times"), F.sum("added").alias("added"))
    )
    running = Window.partitionBy(key, "bucket").orderBy("at", "rank")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        instants.withColumn("so_far", F.coalesce(F.sum("added").over(running), F.lit(0)))
        .where(F.col("rank") != 1)
        .groupBy(key)
        .agg(F.sum(F.col("times") * F.col("so_far")).alias(value))
    )


def _rank(n: int) -> Column:
    return F.lit(n).alias("rank")


def _times(n: int) -> Column:
    return F.lit(n).cast("bigint").alias("times")


def _none() -> Column:
    return F.lit(None).cast("bigint").alias("added")
