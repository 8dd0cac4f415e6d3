from stockledger.operators.checks import split_negative, split_unparsable, with_reason
from stockledger.operators.interval import interval_left_join, interval_left_sum
from stockledger.operators.keyed import (
    latest_by_key,
    reduce_by_key,
    rekey,
    signed_sum,
    sum_by_key,
    windowed_total,
)
from stockledger.operators.lookup import asof_lookup, asof_totals, snapshot_lookup
from stockledger.operators.spine import signed_join, spine_totals, zero_filled

__all__ = [
    "asof_lookup",
    "asof_totals",
    "interval_left_join",
    "interval_left_sum",
    "latest_by_key",
    "reduce_by_key",
    "rekey",
    "signed_join",
    "signed_sum",
    "snapshot_lookup",
    "spine_totals",
    "split_negative",
    "split_unparsable",
    "sum_by_key",
    "windowed_total",
    "with_reason",
    "zero_filled",
]
