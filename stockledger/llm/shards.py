"""Sharding by histogram sort: splitters from exact byte counts, then one exchange.

Rows are ordered by a 64-bit key. The bytes below a set of candidate boundaries are counted
exactly over all partitions, and the candidates close in on each splitter until the bytes
below it are within tolerance of its share. Rows then move once, straight to their shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.shared import BROADCAST_ROWS, written

LOWEST, HIGHEST = -(2**63), 2**63 - 1

# Candidate boundaries tried in one pass for each splitter still open.
PROBES = 15

# Rows of the pieces a shard is numbered in, each a sort of its own; keys are hashes, so pieces of equal width are even.
PIECE_ROWS = 100_000


def interval_of(key: str, bounds: Sequence[int]) -> Column:
    """How many of the sorted bounds are at or below the key column, as a tree of comparisons."""

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"if({key} < {bounds[middle]}L, {tree(low, middle)}, {tree(middle + 1, high)})"

    return F.expr(tree(0, len(bounds)))


def splitters(keyed: DataFrame, n: int, tolerance: float) -> list[int]:
    """n - 1 boundaries: shard i takes keys from boundary i - 1 to below boundary i.

    A boundary may miss its share of the bytes by ``tolerance`` of a shard, or by half the row
    on it where that is more.
    """
    whole = keyed.agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    total = whole["n"] or 0
    wanted = [total * i / n for i in range(1, n)]
    slack = tolerance * total / n
    # Candidate, bytes below it, rows below it.
    low, high = [(LOWEST, 0, 0)] * (n - 1), [(HIGHEST, total, whole["rows"])] * (n - 1)
    done: list[int | None] = [LOWEST if total == 0 else None] * (n - 1)
    while None in done:
        probes = set()
        for i in (i for i, x in enumerate(done) if x is None):
            (a, under_a, _), (b, under_b, _) = low[i], high[i]
            probes.update(a + (b - a) * k // (PROBES + 1) for k in range(1, PROBES + 1))
            if under_b > under_a:  # where the splitter is if keys are even between the two
                probes.add(a + int((b - a) * ((wanted[i] - under_a) / (under_b - under_a))))
        bounds = sorted(p for p in probes if LOWEST < p < HIGHEST)
        counts = keyed.groupBy(interval_of("key", bounds).alias("interval")).agg(
            F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")
        )
        by_interval = {r["interval"]: r for r in counts.collect()}  # one row per bound at most
        below, size, rows = [], 0, 0
        for i, bound in enumerate(bounds):
            if found := by_interval.get(i):
                size, rows = size + found["n"], rows + found["rows"]
            below.append((bound, size, rows))
        for i in (i for i, x in enumerate(done) if x is None):
            low[i] = max([low[i], *(x for x in below if x[1] <= wanted[i])])
            high[i] = min([high[i], *(x for x in below if x[1] >= wanted[i])])
            near = min(low[i], high[i], key=lambda x: abs(x[1] - wanted[i]))
            if abs(near[1] - wanted[i]) <= slack or high[i][2] - low[i][2] <= 1 or high[i][0] - low[i][0] <= 1:
                done[i] = near[0]
    return sorted(done)  # type: ignore[type-var]


def shard_by_bytes(rows: DataFrame, size: str, n: int, order: Sequence[str], tolerance: float = 0.002) -> DataFrame:
    """The rows with shard (0 to n - 1) and slot (gapless from 0 in each shard).

    Bytes of the shards differ by the tolerance at each end, or by one row where rows are larger. The key is a
    hash of the ``order`` columns and of the row's place in the written table, so copies
    of a row spread like any others. A null size counts as zero. An empty table gives an empty one. Columns
    called key, shard, slot, piece or offset are rejected.
    """
    if clash := {"key", "shard", "slot", "piece", "offset"} & set(rows.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    placed = F.xxhash64(*order, F.monotonically_increasing_id())
    keyed = written(rows.withColumn("key", placed))
    sized = keyed.select("key", F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size"))
    bounds = splitters(sized, n, tolerance)
    pieces = max(1, -(-keyed.count() // (n * PIECE_ROWS)))
    # Halves of keys, as the distance of two longs may not be one.
    lows = [b >> 1 for b in (LOWEST, *bounds)]
    steps = [min(((high >> 1) - low) // pieces + 1, HIGHEST) for low, high in zip(lows, [*bounds, HIGHEST])]
    into = F.shiftright("key", 1) - F.get(F.array(*[F.lit(x).cast("bigint") for x in lows]), F.col("shard"))
    wide = F.get(F.array(*[F.lit(x).cast("bigint") for x in steps]), F.col("shard"))
    dealt = keyed.withColumn("shard", interval_of("key", bounds)).withColumn(
        "piece", F.call_function("div", into, wide).cast("int")
    )
    # Rows of the shard's pieces before, from an exact count of each.
    counts = dealt.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    few = n * pieces <= BROADCAST_ROWS
    within = Window.partitionBy("shard", "piece").orderBy("key")
    return (
        dealt.withColumn("slot", F.row_number().over(within).cast("bigint") - 1)
        .join(F.broadcast(offsets) if few else offsets, ["shard", "piece"])
        .withColumn("slot", F.col("slot") + F.col("offset"))
        .select(*rows.columns, "slot", F.col("shard").cast("int").alias("shard"))
    )
