"""Connected components of a table of links, by label passing with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); a component is named by its smallest id.

    Every round replaces the links by stars: each id is linked to the smallest id it can see, first
    from the side of the larger ids, then from the smaller. Rounds grow with the logarithm
    of the longest chain. Each is written, so a lost executor costs one round. A hot id
    is aggregated on the map side before it is shuffled. Nothing is collected but one number a round. Links with a null end or
    of an id with itself say nothing; repeated links are one; without links there are no ids.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    size = _size(edges)
    while size[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        # Larger neighbours of each id go to the smallest id it sees.
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = small.where("a <> b").unionByName(low.select("a", F.col("low").alias("b"))).distinct()
        edges = written(stars.where("a > b"))
        now = _size(edges)
        if now == size:
            break
        size = now
    roots = edges.groupBy("a").agg(F.min("b").alias("b"))
    return roots.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _size(edges: DataFrame) -> tuple:
    """Number and checksum of the links: equal in two rounds when nothing changes any more."""
    sums = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).first()
    return sums["n"], sums["s"]
