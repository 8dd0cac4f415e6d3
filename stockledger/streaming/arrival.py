"""Category lookup by arrival: a fact gets the category its item had when the fact came in.

The item's category is kept as state per item. A hot item would put all its facts
into one task, so facts are spread over ``salts`` groups per item by their arrival
number and every item change goes to all of them: each group sees all the changes
and a share of the facts, and a fact's category does not depend on other facts.

A group's rows of a micro-batch come in chunks and in no order. Its changes are held; of its facts one chunk at a
time, the others wait in state until all changes are known.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stockledger.functions import required
from stockledger.schemas import UNKNOWN_CATEGORY
from stockledger.streaming.state import use_rocksdb

_OUT = "category_id bigint, kind string, quantity bigint"
_FACTS = pa.schema([("seq", pa.int64()), ("kind", pa.string()), ("quantity", pa.int64())])


class _CurrentCategory(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self._category = handle.getValueState("category", "category_id bigint")
        self._waiting = handle.getListState("waiting", "facts binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        at, categories, held, spilled = [], [], None, False
        for chunk in rows:
            is_change = chunk["is_change"].to_numpy(bool)
            at.append(chunk["seq"].to_numpy()[is_change])
            categories.append(chunk["category_id"].to_numpy()[is_change])
            if not is_change.all():
                if held is not None:
                    packed = pa.RecordBatch.from_pandas(held, _FACTS, preserve_index=False).serialize()
                    self._waiting.appendValue((packed.to_pybytes(),))
                    spilled = True
                held = chunk.loc[~is_change, _FACTS.names]
        at, categories = np.concatenate(at), np.concatenate(categories)
        order = np.argsort(at, kind="stable")
        at, categories = at[order], categories[order]
        if held is not None:
            before = self._category.get()
            # What held before the first change, then every change.
            known = np.append(before[0] if before else UNKNOWN_CATEGORY, categories)
            yield _looked_up(held, at, known)
            if spilled:
                for (packed,) in self._waiting.get():
                    facts = pa.ipc.read_record_batch(pa.py_buffer(bytes(packed)), _FACTS).to_pandas()
                    yield _looked_up(facts, at, known)
                self._waiting.clear()
        if len(at):
            self._category.update((int(categories[-1]),))

    def close(self) -> None:
        pass


def _looked_up(facts: pd.DataFrame, at: np.ndarray, known: np.ndarray) -> pd.DataFrame:
    """Facts under the last change at or before them: changes come before facts of the same moment."""
    category = known[np.searchsorted(at, facts["seq"].to_numpy(), side="right")]
    return pd.DataFrame(
        {"category_id": category, "kind": facts["kind"].to_numpy(), "quantity": facts["quantity"].to_numpy()}
    )


def category_at_arrival(
    facts: DataFrame, item_changes: DataFrame, order: str = "seq", salts: int | Callable[[Column], Column] = 8
) -> DataFrame:
    """Stream of (category_id, kind, quantity), 999999 where the item was not known yet.

    ``facts`` is (item_id, kind, quantity, <order>), ``item_changes`` (item_id,
    category_id, <order>); ``order`` must be comparable across both: a common
    arrival number, or the record time in microseconds. ``salts`` is the number of groups an
    item's facts are spread over, or gives it for an item id, more for hot ones; it must stay the same for
    an item as long as the stream lives. A group holds its changes of one micro-batch and one chunk of its
    facts (spark.sql.execution.arrow.maxRecordsPerBatch).
    """
    use_rocksdb(facts.sparkSession)
    groups = salts(F.col("item_id")).cast("int") if callable(salts) else F.lit(salts)
    zero = F.lit(0).cast("bigint")
    order_column = F.col(order).cast("bigint").alias("seq")
    mine = facts.select(
        "item_id",
        F.pmod(F.xxhash64("item_id", order), groups).cast("int").alias("salt"),
        F.lit(False).alias("is_change"),
        zero.alias("category_id"),
        "kind",
        required("quantity", "quantity").alias("quantity"),
        order_column,
    )
    changes = item_changes.select(
        "item_id",
        F.explode(F.sequence(F.lit(0), groups - 1)).alias("salt"),
        F.lit(True).alias("is_change"),
        required("category_id", "category_id").alias("category_id"),
        F.lit("").alias("kind"),
        zero.alias("quantity"),
        order_column,
    )
    return (
        mine.unionByName(changes)
        .groupBy("item_id", "salt")
        .transformWithStateInPandas(
            statefulProcessor=_CurrentCategory(),
            outputStructType=_OUT,
            outputMode="Update",
            timeMode="None",
        )
    )
