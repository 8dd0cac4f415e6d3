"""Stock and possession totals over retail change data, on Spark."""
