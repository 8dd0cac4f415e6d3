"""The eleven named totals, their raw forms and their variants.

All of them come from three wide totals, one per key, each a single union and
aggregate (``spine_totals``). By-category totals aggregate the item totals once
more: the category of a fact is a function of its item, so facts are summed per
item first and meet their category in that same aggregate. No fact is joined,
and the second exchange carries at most one row per category and task.

The same plans run on streaming feeds in update mode, except the by-category
ones: two aggregates in a row are not allowed there. ``stockledger.streaming``
has those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions import non_negative, or_unknown, zero_fill
from stockledger.operators.spine import spine_totals, zero_filled
from stockledger.plans.feeds import KINDS, Feeds


class Ledger:
    def __init__(self, feeds: Feeds):
        self.feeds = feeds

    # Wide totals: one row per key on either side, seq null off the spine.

    def item_totals(
        self, kinds: Sequence[str] = KINDS, attributes: Sequence[str] = ()
    ) -> DataFrame:
        moves = self.feeds.moves("item_id", kinds)
        return spine_totals(self.feeds.item, moves, "item_id", kinds, attributes)

    def customer_totals(self, kinds: Sequence[str] = ("sold", "returned")) -> DataFrame:
        moves = self.feeds.moves("customer_id", kinds)
        return spine_totals(self.feeds.customer, moves, "customer_id", kinds)

    def categorised_items(self, kinds: Sequence[str] = KINDS) -> DataFrame:
        """Item totals with the items' latest category; a negative quantity fails, as by category it must."""
        moves = self.feeds.moves("item_id", kinds).select(
            "item_id", *[non_negative(k).alias(k) for k in kinds]
        )
        return spine_totals(self.feeds.item, moves, "item_id", kinds, ["category_id"])

    def category_moves(self, kinds: Sequence[str] = KINDS) -> DataFrame:
        """Item totals under their item's latest category, unknown ones under the sentinel."""
        items = self.categorised_items(kinds)
        return items.select(or_unknown("category_id").alias("category_id"), *kinds)

    def category_totals(
        self, kinds: Sequence[str] = KINDS, spine: DataFrame | None = None
    ) -> DataFrame:
        spine = self.feeds.category if spine is None else spine
        return spine_totals(spine, self.category_moves(kinds), "category_id", kinds)

    # 1-3: by item.

    def replenished_by_item(self) -> DataFrame:
        return _filled(self.item_totals(["replenished"]), "item_id", "replenished")

    def sold_by_item(self) -> DataFrame:
        return _filled(self.item_totals(["sold"]), "item_id", "sold")

    def returned_by_item(self) -> DataFrame:
        return _filled(self.item_totals(["returned"]), "item_id", "returned")

    # 4-5: by customer.

    def sold_by_customer(self) -> DataFrame:
        return _filled(self.customer_totals(["sold"]), "customer_id", "sold")

    def returned_by_customer(self) -> DataFrame:
        return _filled(self.customer_totals(["returned"]), "customer_id", "returned")

    # 6-8: by category.

    def replenished_by_category(self) -> DataFrame:
        return _filled(self.category_totals(["replenished"]), "category_id", "replenished")

    def sold_by_category(self) -> DataFrame:
        return _filled(self.category_totals(["sold"]), "category_id", "sold")

    def returned_by_category(self) -> DataFrame:
        return _filled(self.category_totals(["returned"]), "category_id", "returned")

    # 9-11: what is left where.

    def items_at_hand(self) -> DataFrame:
        return _combined(self.item_totals(), "item_id", at_hand())

    def items_with_customer(self) -> DataFrame:
        return _combined(self.customer_totals(), "customer_id", held())

    def items_at_hand_by_category(self) -> DataFrame:
        return _combined(self.category_totals(), "category_id", at_hand())

    # As first wired: 6, 8 and 11 laid over the customer ids instead of the categories.

    def replenished_by_category_as_wired(self) -> DataFrame:
        return self._over_customers("replenished")

    def returned_by_category_as_wired(self) -> DataFrame:
        return self._over_customers("returned")

    def items_at_hand_by_category_as_wired(self) -> DataFrame:
        """Sales count only under ids that are categories, as 7 is laid over those.

        One pass of the item totals, marked with both spines in one aggregate.
        """
        customers = self.feeds.customer.select(
            F.col("customer_id").alias("category_id"), F.lit(True).alias("laid_over")
        )
        categories = self.feeds.category.select("category_id", F.lit(True).alias("is_category"))
        totals = (
            self.category_moves()
            .unionByName(customers, allowMissingColumns=True)
            .unionByName(categories, allowMissingColumns=True)
            .groupBy("category_id")
            .agg(
                *[F.sum(k).alias(k) for k in KINDS],
                *[F.max(m).alias(m) for m in ("laid_over", "is_category")],
            )
        )
        sold = F.when(F.col("is_category"), zero_fill("sold")).otherwise(F.lit(0).cast("bigint"))
        return totals.where("laid_over").select(
            "category_id",
            (zero_fill("replenished") - sold + zero_fill("returned")).alias("quantity"),
        )

    def _over_customers(self, kind: str) -> DataFrame:
        spine = self.feeds.customer.select(F.col("customer_id").alias("category_id"), "seq")
        return _filled(self.category_totals([kind], spine), "category_id", kind)

    # Raw totals: keys seen in the facts, whether the spine has them or not.

    def raw_by_item(self, kind: str) -> DataFrame:
        return _raw(self.feeds.moves("item_id", [kind]), "item_id", kind)

    def raw_by_customer(self, kind: str) -> DataFrame:
        return _raw(self.feeds.moves("customer_id", [kind]), "customer_id", kind)

    def raw_by_category(self, kind: str) -> DataFrame:
        moves = self.category_moves([kind]).where(F.col(kind).isNotNull())
        return _raw(moves, "category_id", kind)

    # Totals of the facts alone, without a spine.

    def sold_minus_returned_no_spine(self) -> DataFrame:
        """Per customer with a sale."""
        return _without_spine(
            self.feeds.moves("customer_id", ["sold", "returned"]), "customer_id", "sold", held()
        )

    def stock_by_category_no_spine(self) -> DataFrame:
        """Per category with a replenishment, the sentinel among them."""
        return _without_spine(self.category_moves(), "category_id", "replenished", at_hand())


def at_hand() -> Column:
    """What came in, less what went out, plus what came back."""
    return zero_fill("replenished") - zero_fill("sold") + zero_fill("returned")


def held() -> Column:
    return zero_fill("sold") - zero_fill("returned")


def total_value(column: str) -> Column:
    """A column of the wide totals by name, zero filled, those that combine others included."""
    combined = {"at_hand": at_hand, "held": held}
    return combined[column]() if column in combined else zero_fill(column)


def _filled(totals: DataFrame, key: str, kind: str) -> DataFrame:
    return zero_filled(totals, key, [kind]).withColumnRenamed(kind, "quantity")


def _combined(totals: DataFrame, key: str, quantity: Column) -> DataFrame:
    return totals.where(F.col("seq").isNotNull()).select(key, quantity.alias("quantity"))


def _raw(moves: DataFrame, key: str, kind: str) -> DataFrame:
    return moves.groupBy(key).agg(F.sum(kind).alias("quantity"))


def _without_spine(moves: DataFrame, key: str, first: str, quantity: Column) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in moves.columns if c != key]
    return (
        moves.groupBy(key).agg(*sums).where(F.col(first).isNotNull())
        .select(key, quantity.alias("quantity"))
    )
