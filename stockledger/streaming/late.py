"""Windowed totals whose state is bounded by a watermark, with the rows that come too late kept aside.

Spark's own watermark drops late rows and leaves their number only. Here a batch is checked against the clock its predecessors left, the
newest event time seen less the lateness allowed: rows of windows that end by then go to a table of their own, the
others are added to the windows still open. Windows the clock has passed are final, are written once and not read again, so a batch
reads its rows, one row of the clock and the open windows, however long the history is.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockledger.sources.kept import BatchLog

_CLOCK = "newest bigint"


class BoundedWindows:
    """Totals per key and time window of a stream of ``events``: a sum of ``value``, or a row count without one.

    Tumbling windows without ``slide``, hopping ones with it. ``late`` is how far behind the newest event a row may be. Under hopping
    windows a row is checked against each of its windows.
    """

    def __init__(
        self,
        log: BatchLog,
        events: T.StructType,
        key: str,
        ts: str,
        size: str,
        late: timedelta,
        slide: str | None = None,
        value: str | None = None,
    ):
        self.log, self.events, self.key, self.ts, self.value = log, events, key, ts, value
        self.window = F.window(ts, size, slide) if slide else F.window(ts, size)
        self.late = int(late.total_seconds() * 1_000_000)

    def keep(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Keep the totals of a streaming feed and the rows that come too late for them."""
        return (
            events.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self._write)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        """Reads what the batch before left and writes its own directories, so repeating it changes nothing."""
        before = self._newest(self.log.batch("clock", batch_id - 1, _CLOCK))
        mine = self._newest(batch.select(F.unix_micros(self.ts).alias("newest")))
        newest = max((n for n in (before, mine) if n is not None), default=None)
        cut = F.lit(None).cast("timestamp") if before is None else F.timestamp_micros(F.lit(before - self.late))
        rows = batch.withColumn("w", self.window).select("*", "w.start", "w.end").drop("w")
        too_late = F.coalesce(F.col("end") <= cut, F.lit(False))
        late = rows.where(too_late).withColumnsRenamed({"start": "window_start", "end": "window_end"})
        self.log.write("late", late.unionByName(self._untimed(batch), allowMissingColumns=True), batch_id)

        total = F.count(F.lit(1)) if self.value is None else F.sum(self.value)
        added = rows.where(~too_late).groupBy(self.key, F.col("start").alias("window_start"), F.col("end").alias("window_end"))
        kept = self.log.batch("windows", batch_id - 1, self._schema()).where("NOT final").drop("final")
        windows = (
            added.agg(total.alias("total")).unionByName(kept)
            .groupBy(self.key, "window_start", "window_end").agg(F.sum("total").alias("total"))
        )
        passed = F.lit(False) if newest is None else F.unix_micros("window_end") <= newest - self.late
        self.log.write("windows", windows.withColumn("final", passed), batch_id, "final")
        clock = batch.sparkSession.range(1).select(F.lit(newest).cast("bigint").alias("newest"))
        self.log.write("clock", clock, batch_id)

    def _newest(self, rows: DataFrame) -> int | None:
        return rows.agg(F.max("newest")).first()[0]

    def _untimed(self, batch: DataFrame) -> DataFrame:
        """Rows no window takes, for want of a time."""
        return batch.where(F.col(self.ts).isNull())

    def _schema(self) -> str:
        kind = self.events[self.key].dataType.simpleString()
        return f"{self.key} {kind}, window_start timestamp, window_end timestamp, total bigint, final boolean"

    def totals(self) -> DataFrame:
        """(key, window_start, window_end, total) of all windows, final and open."""
        whole = self.log.read("windows", f"{self._schema()}, batch_id bigint")
        return whole.where(F.col("final") | (F.col("batch_id") == self.log.last("windows"))).drop("final", "batch_id")

    def late_rows(self) -> DataFrame:
        """The events that came too late, once for each window that was final by then, and those without a time."""
        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.events)
        return self.log.read("late", f"{names}, window_start timestamp, window_end timestamp")
