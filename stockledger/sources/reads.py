"""Reads over kept tables: by key, by key range, in full, or by key and time window.

All are filters on the table's own columns, which Spark pushes below the
latest-per-key aggregate into the parquet scan; snapshots are written sorted by
key, so row groups outside the range are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(table: DataFrame, key: int) -> DataFrame:
    """The row of one key; empty when the table does not have it."""
    return table.where(F.col("key") == key)


def key_range(table: DataFrame, low: int, high: int) -> DataFrame:
    """Rows with low <= key <= high."""
    return table.where(F.col("key").between(low, high))


def window_fetch(
    windows: DataFrame, key_column: str, key: str | int, from_ms: int, to_ms: int
) -> DataFrame:
    """One key's windows that start within [from_ms, to_ms]: (window start in ms, total)."""
    starts = F.col("window_start").between(
        F.timestamp_millis(F.lit(from_ms)), F.timestamp_millis(F.lit(to_ms))
    )
    return windows.where((F.col(key_column) == key) & starts).select(
        F.unix_millis("window_start").alias("key"), F.col("total").alias("value")
    )
