"""Permissive twins of the failing checks: good rows and rejects as two DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions import try_long


def split_unparsable(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose text columns are all whole numbers (parsed), and the rest (as they came)."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | try_long(c).isNull()
    good = df.where(~bad).withColumns({c: try_long(c) for c in columns})
    return good, df.where(bad)


def split_negative(df: DataFrame, column: str = "quantity") -> tuple[DataFrame, DataFrame]:
    """Rows with a value of zero or more, and rows with a null or negative one."""
    ok = F.coalesce(F.col(column) >= 0, F.lit(False))
    return df.where(ok), df.where(~ok)


def with_reason(df: DataFrame, numbers: Sequence[str], amounts: Sequence[str] = ()) -> DataFrame:
    """Rows of texts with a ``reason``: the first column that is no whole number, or else the first negative amount; null where none is."""
    bad = [F.when(try_long(c).isNull(), F.lit(f"unparsable: {c}")) for c in numbers]
    below = [F.when(try_long(c) < 0, F.lit(f"negative: {c}")) for c in amounts]
    none = F.lit(None).cast("string")
    return df.withColumn("reason", F.coalesce(*bad, *below, none))
