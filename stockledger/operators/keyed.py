"""Re-keying and the keyed aggregates.

Every aggregate here is one partial and one final aggregate around one exchange. The partial step leaves at most one row per key and task, so a key
that holds a third of the rows costs no more in the exchange than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions import signed_case


def rekey(df: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
    """Project records to (key, value)."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.col(value) if isinstance(value, str) else value
    return df.select(key.alias("key"), value.alias("value"))


def sum_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Running total per key; keys without rows do not appear."""
    return df.groupBy(key).agg(F.sum(value).alias(value))


def latest_by_key(df: DataFrame, key: str, values: Sequence[str], order: str = "seq") -> DataFrame:
    """Newest values per key by arrival order, which must be unique within a key.

    One aggregate per column rather than one of a struct: buffers of fixed-width
    columns can be updated in place, so the aggregate hashes. With a text among the
    values it sorts.
    """
    return df.groupBy(key).agg(*[F.max_by(v, order).alias(v) for v in values])


def reduce_by_key(
    df: DataFrame, key: str, value: str, how: str | Sequence[str], order: str = "seq"
) -> DataFrame:
    """Reduce the values of a key with built-in associative functions.

    ``how`` names one or more of sum, min, max, latest; each becomes a column
    ``<how>_<value>``.
    """
    hows = [how] if isinstance(how, str) else list(how)
    built = {
        "sum": lambda: F.sum(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "latest": lambda: F.max_by(value, order),
    }
    unknown = [h for h in hows if h not in built]
    if unknown or not hows:
        raise ValueError(f"how must name some of {sorted(built)}, got {hows}")
    return df.groupBy(key).agg(*[built[h]().alias(f"{h}_{value}") for h in hows])


def signed_sum(df: DataFrame, key: str, value: str, sign: str = "sign") -> DataFrame:
    """Total per key over change rows, '+' for a new value and '-' for one withdrawn."""
    return df.groupBy(key).agg(F.sum(signed_case(sign, value)).alias(value))


def windowed_total(
    df: DataFrame,
    key: str,
    ts: str,
    size: str,
    slide: str | None = None,
    value: str | None = None,
    late: str | None = None,
) -> DataFrame:
    """Total per key and time window: a sum of ``value``, or a row count without one.

    Tumbling windows without ``slide``, hopping ones with it. ``late`` sets the
    watermark of a streaming input. Returns (key, window_start, window_end, total).
    """
    if late is not None:
        df = df.withWatermark(ts, late)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    total = F.count(F.lit(1)) if value is None else F.sum(value)
    return (
        df.groupBy(key, window.alias("w"))
        .agg(total.alias("total"))
        .select(
            key,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "total",
        )
    )
