"""The checks of a feed in the live stream: accepted and rejected rows as two kept outputs of one read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockledger.functions import try_long
from stockledger.operators.checks import with_reason
from stockledger.sources.kept import BatchLog


class CheckedFeed:
    """A feed of texts whose ``numbers`` must be whole numbers, and those of them in ``amounts`` not negative.

    Every micro-batch is read once and written once, in a folder for the accepted and one for the rejected rows, the latter with the
    reason; a repeated batch overwrites both.
    """

    def __init__(self, log: BatchLog, name: str, schema: T.StructType, numbers: Sequence[str], amounts: Sequence[str] = ()):
        self.log, self.name, self.schema = log, name, schema
        self.numbers, self.amounts = list(numbers), list(amounts)

    def keep(self, feed: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        checked = with_reason(feed, self.numbers, self.amounts).withColumn("accepted", F.col("reason").isNull())

        def write(rows: DataFrame, batch_id: int) -> None:
            self.log.write(self.name, rows, batch_id, "accepted")

        return (
            checked.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )

    def _read(self, accepted: bool) -> DataFrame:
        extra = [T.StructField("reason", T.StringType()), T.StructField("accepted", T.BooleanType())]
        whole = self.log.read(self.name, T.StructType([*self.schema, *extra]))
        return whole.where(F.col("accepted") if accepted else ~F.col("accepted")).drop("accepted")

    def accepted(self) -> DataFrame:
        """The rows that passed, their numbers as longs."""
        return self._read(True).drop("reason").withColumns({c: try_long(c) for c in self.numbers})

    def rejected(self) -> DataFrame:
        """The rows that did not, as they came, with the reason: 'unparsable: <column>' or 'negative: <column>'."""
        return self._read(False)
