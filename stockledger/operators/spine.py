"""Totals over a dimension spine as one union and one aggregate.

"Every key of the dimension, with its totals, zero where there are none" is
usually written as one left join per total. Here dimension rows and fact rows
are unioned on the key and aggregated once: all totals of a key and the mark
"the dimension has it" come out of the same exchange. Nothing is broadcast, so
no size has to be known; partial aggregation takes the skew out before the
exchange; and the same code is legal in an update-mode stream, where joining
aggregates is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions import required, zero_fill


def spine_totals(
    spine: DataFrame,
    facts: DataFrame,
    key: str,
    measures: Sequence[str],
    attributes: Sequence[str] = (),
) -> DataFrame:
    """One row per key seen on either side: (key, seq, attributes, measures).

    ``spine`` has the key, its arrival order ``seq`` and the attributes, of which
    the latest is kept; a null ``seq`` fails the query. ``facts`` has the key and the measures, null where a row
    does not carry one. In the result ``seq`` is null for keys the spine lacks,
    and a measure is null for keys without a fact that carries it.
    """
    marks = spine.select(key, required("seq", "seq").alias("seq"), *attributes)
    rows = facts.select(key, *measures)
    return (
        marks.unionByName(rows, allowMissingColumns=True)
        .groupBy(key)
        .agg(
            F.max("seq").alias("seq"),
            *[F.max_by(a, "seq").alias(a) for a in attributes],
            *[F.sum(m).alias(m) for m in measures],
        )
    )


def zero_filled(totals: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """The rows of :func:`spine_totals` the spine has, nulls as zero."""
    return totals.where(F.col("seq").isNotNull()).select(
        key, *[zero_fill(m).alias(m) for m in measures]
    )


def signed_join(
    first: DataFrame, others: Sequence[tuple[int, DataFrame]], key: str, value: str
) -> DataFrame:
    """``first`` plus or minus other totals, missing ones counting zero.

    Equals the left join chain first ⟕ other₁ ⟕ other₂ … on tables with unique
    keys, as one union and one aggregate: keys that ``first`` lacks are dropped.
    """
    rows = first.select(key, value, F.lit(1).alias("mine"))
    for sign, other in others:
        if sign not in (1, -1):
            raise ValueError("sign must be 1 or -1")
        addend = F.col(value) if sign == 1 else -F.col(value)
        added = other.select(key, addend.alias(value))
        rows = rows.unionByName(added, allowMissingColumns=True)
    return (
        rows.groupBy(key)
        .agg(F.max("mine").alias("mine"), F.sum(value).alias(value))
        .where(F.col("mine").isNotNull())
        .select(key, value)
    )
