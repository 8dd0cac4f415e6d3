"""The six feeds of the ledger, and the one fact table the totals are taken from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from stockledger.functions import required

KINDS = ("replenished", "sold", "returned")


class Feeds:
    """Change feeds as DataFrames, all batch or all streaming.

    ``item`` (item_id, category_id, seq), ``customer`` and ``category`` (id, name,
    seq); ``replenishment`` (item_id, quantity), ``sale`` and ``ret`` (item_id,
    customer_id, quantity). Further columns are ignored.
    """

    item: DataFrame
    customer: DataFrame
    category: DataFrame
    replenishment: DataFrame
    sale: DataFrame
    ret: DataFrame

    def moves(self, key: str, kinds: Sequence[str]) -> DataFrame:
        """Facts of the given kinds by ``key``: one bigint column per kind.

        A column is null on rows that are not of its kind. A null key or quantity fails
        the query.
        """
        feeds = {"replenished": "replenishment", "sold": "sale", "returned": "ret"}
        quantity = required("quantity", "quantity")
        parts = [getattr(self, feeds[k]).select(required(key, key).alias(key), quantity.alias(k)) for k in kinds]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@dataclass(frozen=True)
class GivenFeeds(Feeds):
    """Feeds handed over as they are."""

    item: DataFrame
    customer: DataFrame
    category: DataFrame
    replenishment: DataFrame
    sale: DataFrame
    ret: DataFrame
