"""Kept tables: a log of changed rows per batch, and the latest row per key read from it.

``changes/batch_id=N`` holds the keys batch N changed with their new values. Batches are
numbered from 0 without gaps, as a stream numbers them, and a batch that is repeated after a failure
overwrites its own directory. Every ``epoch`` batches the table as it then was
is written whole, sorted by key, to ``snapshot/epoch=E`` before the next batch. So the
paths behind the table before batch N follow from N alone: the last epoch's snapshot and
the batches since, ``epoch`` of them at most. If one of them is not there the read fails.
Tables kept by one stream share its batch numbers, so several of them can be read as of one batch.

Files are sorted by key and carry a Bloom filter of it: a range reads the row groups it touches, and a
point lookup at most one row group of a file.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.plans.ledger import total_value
from stockledger.schemas import LATEST_NAMES, TOTAL_NAMES
from stockledger.sources.sinks import latest_of_changes


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else, with a warning, the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        warnings.warn("spark.checkpoint.dir is not set: kept tables go to the warehouse, which all executors must share", stacklevel=2)
    return named or spark.conf.get("spark.sql.warehouse.dir")


class KeptTables:
    """Tables under one folder; ``epoch`` must be the same for all of a table's life.

    ``options`` are further options of the Parquet writer.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        epoch: int = 100,
        options: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/kept"
        self.epoch = epoch
        self.options = dict(options or {})

    # Writing.

    def writer(self, table: str, only_changed: bool = False) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: append the batch's changed rows to the table's log."""
        if only_changed:
            return lambda rows, batch_id: self.publish_changed(table, rows, batch_id)
        return lambda rows, batch_id: self.publish(table, rows, batch_id)

    def publish(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """Record rows (key, …) as changed by this batch; the first of an epoch seals the one before."""
        ended, into = divmod(batch_id, self.epoch)
        if ended and not into:
            whole = self._through(table, batch_id - 1)
            self._sorted(whole.repartitionByRange("key")).parquet(self._snapshot(table, ended - 1))
        self._sorted(rows).parquet(self._batch(table, batch_id))

    def publish_changed(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """:meth:`publish`, but only rows that differ from what is kept; nulls are compared as values.

        A stream in update mode re-emits every key a batch touches, changed or not. A batch without effect
        leaves an empty directory of its own, so batch numbers stay without gaps.
        """
        self.publish(table, changed(rows, self.view_before(table, batch_id, rows.schema)), batch_id)

    def _sorted(self, rows: DataFrame) -> DataFrameWriter:
        """A writer of files sorted by key, with Bloom filters of the key's columns."""
        kind = rows.schema["key"].dataType
        leaves = [f"key.{f.name}" for f in kind] if isinstance(kind, T.StructType) else ["key"]
        blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in leaves}
        blooms |= {f"parquet.bloom.filter.adaptive.enabled#{c}": "true" for c in leaves}
        return rows.sortWithinPartitions("key").write.mode("overwrite").options(**blooms, **self.options)

    # Reading.

    def changes(self, table: str) -> DataFrame:
        """The whole log, one row per key and batch that changed it."""
        rows = self.spark.read.parquet(f"{self.root}/{table}/changes")
        return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))

    def view(self, table: str) -> DataFrame:
        """The latest row of every key."""
        last = self.last_batch(table)
        if last < 0:
            raise ValueError(f"nothing has been published to {table}")
        return self._through(table, last)

    def view_at(self, table: str, batch_id: int) -> DataFrame:
        """The table as a batch left it; fails where the directories behind it are gone."""
        return self._through(table, batch_id)

    def view_before(self, table: str, batch_id: int, schema: str | T.StructType) -> DataFrame:
        """The table as it was before a batch; empty, with the given schema, before the first."""
        if batch_id == 0:
            return self.spark.createDataFrame([], schema)
        return self._through(table, batch_id - 1)

    def revisions(self, table: str, batch_id: int) -> DataFrame:
        """(key, old, new) of every key a batch published, rows as structs; ``old`` is null where there was none.

        Reads the batch's own rows, and of the table before it only those keys.
        """
        now = self.spark.read.parquet(self._batch(table, batch_id))
        values = [c for c in now.columns if c != "key"]
        new = now.select("key", F.struct(*values).alias("new"))
        keys = now.select(F.col("key").alias("__key"))
        same = F.col("key").eqNullSafe(F.col("__key"))
        before = self.view_before(table, batch_id, now.schema).join(keys, same, "left_semi")
        old = before.select(F.col("key").alias("__key"), F.struct(*values).alias("old"))
        return new.join(old, same, "left").select("key", "old", "new")

    def last_batch(self, table: str) -> int:
        """The newest batch, -1 without any.

        The newest snapshot was sealed just before the batch that follows it, and neither its epoch's batches nor
        those since may have been deleted; the last of them is found by halving.
        """
        low = (self._last_sealed(table) + 1) * self.epoch - 1
        high = low + 1
        while self._is_written(self._batch(table, high)):
            low, high = high, high + 2 * (high - low)
        while high - low > 1:
            middle = (low + high) // 2
            if self._is_written(self._batch(table, middle)):
                low = middle
            else:
                high = middle
        return low

    def last_common(self, *tables: str) -> int:
        """The newest batch that all these tables of one stream have."""
        return min(self.last_batch(t) for t in tables)

    def _last_sealed(self, table: str) -> int:
        """The newest epoch with a snapshot, -1 without any."""
        try:
            files = self.spark.read.parquet(f"{self.root}/{table}/snapshot").inputFiles()
        except AnalysisException:  # no such folder, or no file in it yet
            return -1
        return max((int(n) for f in files for n in re.findall(r"/snapshot/epoch=(\d+)/", f)), default=-1)

    def _is_written(self, path: str) -> bool:
        try:
            self.spark.read.parquet(path)
        except AnalysisException:  # no such folder, or no file in it yet
            return False
        return True

    def _through(self, table: str, last: int) -> DataFrame:
        ended = last // self.epoch
        batches = [self._batch(table, n) for n in range(ended * self.epoch, last + 1)]
        reader = self.spark.read.option("basePath", f"{self.root}/{table}/changes")
        rows = reader.parquet(*batches).withColumn("batch_id", F.col("batch_id").cast("bigint"))
        if ended:
            base = self.spark.read.parquet(self._snapshot(table, ended - 1))
            before = F.lit(ended * self.epoch - 1).cast("bigint")
            rows = base.withColumn("batch_id", before).unionByName(rows)
        values = [c for c in rows.columns if c not in ("key", "batch_id")]
        return latest_of_changes(rows, "key", values)

    def named(self, name: str, batch_id: int | None = None) -> DataFrame:
        """A table by its public name, as (key, value); see ``schemas``. As of a batch, where one is given."""
        if name in LATEST_NAMES:
            table, column = LATEST_NAMES[name]
            rows = self.view(table) if batch_id is None else self.view_at(table, batch_id)
            return rows.where(F.col("seq").isNotNull()).select("key", F.col(column).alias("value"))
        base, raw = _split_name(name)
        table, column = TOTAL_NAMES[base]
        rows = self.view(table) if batch_id is None else self.view_at(table, batch_id)
        if raw:
            return rows.where(F.col(column).isNotNull()).select("key", F.col(column).alias("value"))
        known = rows.where(F.col("seq").isNotNull())
        return known.select("key", total_value(column).alias("value"))

    def windows(self, table: str) -> DataFrame:
        """A kept windowed total as (key, window_start, window_end, total)."""
        return self.view(table).select(
            F.col("key.of").alias("key"), "key.window_start", "window_end", "total"
        )

    # Paths.

    def _batch(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/changes/batch_id={batch_id}"

    def _snapshot(self, table: str, epoch: int) -> str:
        return f"{self.root}/{table}/snapshot/epoch={epoch}"


class BatchLog:
    """Rows appended batch by batch, one directory each; a repeated batch overwrites its own. Read in whole or one batch at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def write(self, table: str, rows: DataFrame, batch_id: int, *parts: str) -> None:
        """The batch's rows, in a folder for each value of ``parts``."""
        rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def read(self, table: str, schema: str | T.StructType) -> DataFrame:
        """All batches' rows with the columns of the schema, ``batch_id`` and those batches were divided by among them if named."""
        names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}").select(*names)

    def batch(self, table: str, batch_id: int, schema: str | T.StructType) -> DataFrame:
        """One batch's rows; none before the first."""
        if batch_id < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def last(self, table: str) -> int:
        """The newest batch with rows, -1 without any."""
        try:
            files = self.spark.read.parquet(f"{self.root}/{table}").inputFiles()
        except AnalysisException:  # no such folder, or no file in it yet
            return -1
        return max((int(n) for f in files for n in re.findall(r"/batch_id=(\d+)/", f)), default=-1)


def changed(rows: DataFrame, before: DataFrame) -> DataFrame:
    """The rows whose key ``before`` lacks or has other values for; a null is a value like any other."""
    values = [c for c in rows.columns if c != "key"]
    kept = before.select(F.col("key").alias("__key"), F.struct(*values).alias("__before"))
    same = _same(F.struct(*values), F.col("__before"), before.schema, values)
    return rows.join(kept, F.col("key").eqNullSafe(F.col("__key")), "left").where(~same).select(*rows.columns)


def _same(now: Column, before: Column, schema: T.StructType, values: Sequence[str]) -> Column:
    """Whether two structs hold the same values; the one before may be absent, and field nullability may differ."""
    alike = F.lit(True)
    for v in values:
        alike = alike & now[v].eqNullSafe(before[v].cast(schema[v].dataType))
    return before.isNotNull() & alike


def _split_name(name: str) -> tuple[str, bool]:
    """The total a public name stands for, and whether it means its raw form."""
    for ending in ("-store-0.8", "-store-0.9", "-store", "-topic", "-0.9"):
        base, raw = name.removesuffix(ending), ending == "-store-0.8"
        if base != name and base in TOTAL_NAMES:
            if raw and TOTAL_NAMES[base][1] in ("at_hand", "held"):
                break
            return base, raw
    raise KeyError(name)
