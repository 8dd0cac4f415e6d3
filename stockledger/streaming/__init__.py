from stockledger.streaming.arrival import category_at_arrival
from stockledger.streaming.batches import keep_category_rows, keep_category_totals
from stockledger.streaming.interval import closing_row, keep_interval_join, keep_interval_left_sums, keep_interval_sums
from stockledger.streaming.kept import add_to_kept, keep_regrouped, retractions
from stockledger.streaming.late import BoundedWindows
from stockledger.streaming.rejects import CheckedFeed
from stockledger.streaming.totals import (
    category_totals_at_arrival,
    keep,
    keep_windows,
    latest_names,
)

__all__ = [
    "BoundedWindows",
    "CheckedFeed",
    "add_to_kept",
    "category_at_arrival",
    "category_totals_at_arrival",
    "closing_row",
    "keep",
    "keep_category_rows",
    "keep_category_totals",
    "keep_interval_join",
    "keep_interval_left_sums",
    "keep_interval_sums",
    "keep_regrouped",
    "keep_windows",
    "latest_names",
    "retractions",
]
