"""Dependent tables: kept totals that the changes of a batch are added to, without reading what was added before again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.functions import signed_case
from stockledger.sources.kept import KeptTables


def add_to_kept(tables: KeptTables, table: str, rows: DataFrame, batch_id: int) -> None:
    """Add rows of (key, bigint measures) to the totals kept before the batch; only the keys they have are published.

    A repeated batch reads the table as it was before it, so nothing is added twice. The rows are read twice; they should
    be a written batch or an aggregate of one.
    """
    measures = [c for c in rows.columns if c != "key"]
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *(T.StructField(m, T.LongType()) for m in measures)])
    sums = [F.sum(m).alias(m) for m in measures]
    added = rows.groupBy("key").agg(*sums)
    before = tables.view_before(table, batch_id, schema)
    keys = added.select(F.col("key").alias("__key"))
    touched = before.join(keys, F.col("key").eqNullSafe(F.col("__key")), "left_semi")
    tables.publish(table, added.unionByName(touched).groupBy("key").agg(*sums), batch_id)


def retractions(revisions: DataFrame, key: Callable[[Column], Column], value: Callable[[Column], Column]) -> DataFrame:
    """What revised rows withdraw and bring: (sign, key, value), '-' with the old row's, '+' with the new one's.

    ``revisions`` is (key, old, new), see ``KeptTables.revisions``. ``key`` and ``value`` are taken of a row, so a row that moves
    to another group is taken back from the one it was in.
    """

    def entry(sign: str, row: Column) -> Column:
        of = F.struct(F.lit(sign).alias("sign"), key(row).alias("key"), value(row).alias("value"))
        return F.when(row.isNotNull(), of)

    entries = F.array_compact(F.array(entry("-", F.col("old")), entry("+", F.col("new"))))
    return revisions.select(F.explode(entries).alias("e")).select("e.sign", "e.key", "e.value")


def keep_regrouped(
    tables: KeptTables,
    source: str,
    target: str,
    batch_id: int,
    key: Callable[[Column], Column],
    value: Callable[[Column], Column],
) -> None:
    """Keep the sum of ``value`` per group of a kept table's rows, from what a batch of it changed.

    The target is (key, value, members): the sum and the number of the group's rows. A group that all rows have left stays
    with no members. Call it after the batch has been published to the source.
    """
    moves = retractions(tables.revisions(source, batch_id), key, value)
    rows = moves.select(
        "key", signed_case("sign", "value").alias("value"),
        signed_case("sign", F.lit(1).cast("bigint")).alias("members"),
    )
    add_to_kept(tables, target, rows, batch_id)
