"""Looking facts up in a changing dimension: its latest state, or its state as of a time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.operators.spread import spread, tasks_for

HOUR = timedelta(hours=1)


def snapshot_lookup(
    facts: DataFrame, latest: DataFrame, key: str, default: int | None = None
) -> DataFrame:
    """facts ⟕ the latest table (one row per key), row by row, facts batch or stream.

    The kind of join is left to adaptive execution, which measures both sides and
    splits hot fact keys. For totals rather than rows, aggregate first: see
    ``spine_totals``.
    """
    joined = facts.join(latest, key, "left")
    return joined.withColumns(
        {c: _or_default(F.col(c), default, latest.schema[c].dataType) for c in latest.columns if c != key}
    )


# As-of joins. Time is cut into buckets. Inside a (key, bucket) the last change is carried
# forward in order; what a bucket inherits is carried from bucket to bucket over one row per
# (key, bucket). No task orders a whole key: a group holds the rows of one bucket, or the
# buckets of one key, and ``bucket`` sets how a long history divides between the two. A
# change is carried as a struct, so a change to null is a change like any other; a key that
# is null has no changes.


def asof_lookup(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    value: str,
    default: int | None = None,
    ts: str = "ts",
    seq: str = "seq",
    bucket: timedelta | int = HOUR,
) -> DataFrame:
    """Each fact with the ``value`` its key had at the fact's time.

    ``default`` stands for a null value and for a fact before the first change. A change at
    the same instant as a fact counts as before it; of several changes at one instant the
    largest ``seq`` wins. ``ts`` may also be a bigint order, with ``bucket`` a number of
    its units. The facts are read twice: once for the instants they ask about, one row per key and instant
    before the exchange, and once whole, to be joined with the answers on (key, instant). No
    task orders facts, and adaptive execution splits the facts of a hot instant.
    """
    asked, told = _asked(facts, key, ts, bucket), _told(changes, key, value, ts, seq, bucket)
    instants = _instants(asked().withColumn("__asked", F.lit(True)).unionByName(told, allowMissingColumns=True))
    instants = spread(instants, tasks_for(facts, changes), "__key", "__bin")
    ordered = Window.partitionBy("__key", "__bin").orderBy("__at")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = instants.withColumn("__own", F.last("__told", ignorenulls=True).over(so_far)).where("__asked")
    inherited = (
        _bins(instants)
        .withColumn("__carried", F.last("__tail", ignorenulls=True).over(_earlier_bins()))
        .where("__asked AND __carried IS NOT NULL")
        .select("__key", "__bin", "__carried")
    )
    answers = own.join(inherited, ["__key", "__bin"], "left").select(
        "__key", "__at", F.coalesce("__own", "__carried").alias("__found")
    )
    at, _ = _placed(_at(facts, ts), bucket)
    rows = facts.select(F.struct(*[F.col(c) for c in facts.columns]).alias("__fact"), F.col(key).alias("__key"), at)
    return rows.join(answers.where("__found IS NOT NULL"), ["__key", "__at"], "left").select(
        *[F.col("__fact")[c].alias(c) for c in facts.columns],
        _or_default(F.col("__found")["value"], default, changes.schema[value].dataType).alias(value),
    )


def asof_totals(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    value: str,
    measures: Sequence[str],
    default: int | None = None,
    ts: str = "ts",
    seq: str = "seq",
    bucket: timedelta | int = HOUR,
) -> DataFrame:
    """Sums of the measures per looked-up ``value``, see :func:`asof_lookup`; the facts are read once.

    Facts and changes are collapsed to one row per key and instant, which the answer is a
    function of. Facts a bucket cannot answer itself all have the same answer, the last
    change of the buckets before, so they are one row of sums by the time it is looked for.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    asked = _asked(facts, key, ts, bucket)(*measures).withColumn("__asked", F.lit(True))
    told = _told(changes, key, value, ts, seq, bucket)
    tasks = tasks_for(facts, changes)
    instants = spread(_instants(asked.unionByName(told, allowMissingColumns=True), *sums), tasks, "__key", "__bin")
    ordered = Window.partitionBy("__key", "__bin").orderBy("__at")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = (
        instants.withColumn("__own", F.last("__told", ignorenulls=True).over(so_far))
        .groupBy("__key", "__bin", "__own")
        .agg(
            F.max("__asked").alias("__asked"),
            F.max(F.when(F.col("__own").isNotNull(), F.col("__at"))).alias("__held_until"),
            *sums,
        )
    )
    earlier = Window.partitionBy("__key").orderBy("__bin").rangeBetween(Window.unboundedPreceding, -1)
    carried = F.max_by("__own", "__held_until").over(earlier)
    found = F.coalesce("__own", "__carried")["value"]
    return (
        spread(within, tasks, "__key").withColumn("__carried", carried)
        .where("__asked")
        .select(_or_default(found, default, changes.schema[value].dataType).alias(value), *measures)
        .groupBy(value)
        .agg(*sums)
    )


def _or_default(found: Column, default: int | None, kind) -> Column:
    return found if default is None else F.coalesce(found, F.lit(default).cast(kind))


def _at(df: DataFrame, ts: str) -> Column:
    return F.col(ts) if dict(df.dtypes)[ts] == "bigint" else F.unix_micros(F.col(ts).cast("timestamp"))


def _placed(at: Column, bucket: timedelta | int) -> tuple[Column, Column]:
    """The instant and its bucket, in whole numbers all the way."""
    width = bucket if isinstance(bucket, int) else int(bucket.total_seconds() * 1_000_000)
    down = F.when(at % width < 0, 1).otherwise(0)
    return at.alias("__at"), (F.call_function("div", at, F.lit(width)) - down).alias("__bin")


def _asked(facts: DataFrame, key: str, ts: str, bucket: timedelta | int):
    """The facts' keys, instants and buckets, with any more columns."""
    placed = _placed(_at(facts, ts), bucket)
    return lambda *more: facts.select(F.col(key).alias("__key"), *placed, *more)


def _told(
    changes: DataFrame, key: str, value: str, ts: str, seq: str, bucket: timedelta | int
) -> DataFrame:
    return changes.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"),
        *_placed(_at(changes, ts), bucket),
        F.col(seq).cast("bigint").alias("__seq"),
        F.col(value).alias("__value"),
        F.lit(True).alias("__told_any"),
    )


def _instants(rows: DataFrame, *sums: Column) -> DataFrame:
    """One row per key and instant, with ``__told``: the change that wins there as a struct, null where there is none.

    The struct is made behind the aggregate, whose buffers are then of fixed width and hash.
    """
    found = rows.groupBy("__key", "__bin", "__at").agg(
        F.max_by("__value", "__seq").alias("__value"), F.max("__told_any").alias("__told_any"),
        F.max("__asked").alias("__asked"), *sums,
    )
    return found.withColumn("__told", _struct_if("__told_any")).drop("__value", "__told_any")


def _struct_if(mark: str) -> Column:
    return F.when(F.col(mark), F.struct(F.col("__value").alias("value")))


def _bins(instants: DataFrame) -> DataFrame:
    """One row per (key, bucket): whether facts ask about it, and the last change in it."""
    told = F.col("__told").isNotNull()
    last = instants.groupBy("__key", "__bin").agg(
        F.max("__asked").alias("__asked"), F.max(F.when(told, True)).alias("__told_any"),
        F.max_by(F.col("__told")["value"], F.when(told, F.col("__at"))).alias("__value"),
    )
    return last.withColumn("__tail", _struct_if("__told_any")).drop("__value", "__told_any")


def _earlier_bins():
    return Window.partitionBy("__key").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
