"""Exact duplicates through an extendible hash index: texts meet only in the bucket of their hash, byte by byte.

A text's key is a 64-bit hash. Keys of one row need no comparing, so the index holds those that
several rows share. Its directory is indexed by the top bits of a key: as long as a bucket is overfull (more
than ``BUCKET_BYTES`` of texts under more than one key) the directory doubles and the overfull buckets are
split by one more bit; the others keep the depth they have and fill several slots. The directory and the keys' buckets are
tables in the shared folder. A bucket is a range of keys and belongs to one owner task, which gets all its texts and
chains under each key the texts that differ. A key too large for a bucket has its copies folded on the map
side before they go to the owner. Column expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.shared import BROADCAST_ROWS, semi, without, written

# Bytes of texts, before copies are folded, from which a bucket is overfull.
BUCKET_BYTES = 4 * 1024 * 1024

# A group with more than this part of all rows is answered by a broadcast, of fewer rows than this therefore.
HOT_PARTS = 1000


def normalised(text: Column) -> Column:
    """The text with each run of blanks as one space; null as empty. Single spaces are left as they are."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_duplicates(
    docs: DataFrame, key_of: Callable[[str], Column] = F.xxhash64, capacity: int = BUCKET_BYTES
) -> DataFrame:
    """Every row of ``docs`` with its group of equal normalised texts.

    Returns (doc_id, keep_id, group_size, kept, text_sha256, chain): the smallest doc_id of the group, its rows, whether this row
    stays, the digest of the normalised text, and the text's place among those under its key (0 but for collisions).
    Null texts are empty texts and form a group with them. Of a row that is repeated one stays. Null ids come after all others;
    a group with nothing else keeps one of its rows and has a null keep_id. No row: no row. Other columns are ignored; texts
    may be of any length a row can hold.
    """
    rows = written(
        docs.select("doc_id", normalised(F.col("text")).alias("text"))
        .select(
            "doc_id", key_of("text").alias("key"), F.octet_length("text").cast("bigint").alias("bytes"),
            F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        )
        .withColumn("place", F.monotonically_increasing_id())
    )
    keys = written(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).where("n > 1")
    )
    index = _placed(keys, capacity)
    links = _links(docs, index, key_of)
    # Which row stays: one with the smallest id, and of rows that are repeated any one.
    heads = semi(rows, keys.select("key"), "key").groupBy("key", "text_sha256").agg(
        F.coalesce(F.min_by("place", "doc_id"), F.min("place")).alias("head")
    )
    answers = written(links.join(heads, ["key", "text_sha256"]))
    return _answered(rows, answers).select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("place") == F.col("head"), F.lit(True)).alias("kept"),
        "text_sha256",
        F.coalesce("chain", F.lit(0)).alias("chain"),
    )


def firsts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; see :func:`exact_duplicates`."""
    found = written(exact_duplicates(docs).select("doc_id", "text_sha256", "kept"))
    # Rows that are repeated have the digest and the id of the one that stays, and are told apart by nothing.
    names = ["doc_id", "text_sha256"]
    of_row = found.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("stays"))
    gone = written(of_row.where("NOT stays").select(*names))
    repeated = written(of_row.where("stays AND n > 1").select(*names))
    digest = F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256")
    left = without(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", digest), gone, *names)
    once = without(left, repeated, *names)
    marked = repeated.select(F.col("doc_id").alias("again_id"), F.col("text_sha256").alias("again_sha256"))
    same = F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("text_sha256") == F.col("again_sha256"))
    again = left.join(marked, same, "left_semi").dropDuplicates(names)
    return once.unionByName(again).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _placed(keys: DataFrame, capacity: int) -> DataFrame:
    """(key, bucket, heavy) of every key; heavy ones alone overfill a bucket."""
    slots, depth = directory(keys, capacity)
    found = keys.select(
        "key", (F.col("bytes") > capacity).alias("heavy"), F.shiftrightunsigned("key", 64 - depth).alias("slot")
    )
    few = slots.count() <= BROADCAST_ROWS
    return written(found.join(F.broadcast(slots) if few else slots, "slot").select("key", "bucket", "heavy"))


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The directory of the keys (key, bytes, …): a written table (slot, bucket, depth), and how many top bits make a slot.

    ``depth`` is the bucket's own. The rounds work on a histogram of the keys, some 64 to 256 cells a bucket; the driver hears one
    number of each. Cells that are overfull at the histogram's depth stay so.
    """
    weight = F.least(F.col("bytes"), F.lit(capacity))
    total = keys.agg(F.sum(weight)).first()[0] or 0
    fine = min(6 + max(total // capacity, 2).bit_length(), 48)
    cells = written(
        keys.groupBy(F.shiftrightunsigned("key", 64 - fine).alias("cell"))
        .agg(F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("n"))
    )
    depth, buckets = 1, []
    while True:
        at = F.shiftright("cell", fine - depth)
        level = written(
            cells.groupBy(at.alias("at")).agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))
            .withColumn("over", (F.col("weight") > capacity) & (F.col("n") > 1) & F.lit(depth < fine))
        )
        buckets.append((depth, level.where("NOT over")))
        over = level.where("over").select("at")
        if over.isEmpty():
            break
        cells = written(cells.join(over, at == F.col("at"), "left_semi"))
        depth += 1
    slots = None
    for own, level in buckets:
        wide = depth - own
        first = F.shiftleft("at", wide)
        some = level.select(
            F.explode(F.sequence(first, first + F.lit(2**wide - 1).cast("bigint"))).alias("slot"),
            first.alias("bucket"), F.lit(own).alias("depth"),
        )
        slots = some if slots is None else slots.unionByName(some)
    return written(slots), depth


def _links(docs: DataFrame, index: DataFrame, key_of: Callable[[str], Column]) -> DataFrame:
    """(key, text_sha256, keep_id, group_size, chain): the texts under every key of the index, compared by their owners."""
    few = index.count() <= BROADCAST_ROWS
    found = (
        docs.select("doc_id", normalised(F.col("text")).alias("text"))
        .withColumn("key", key_of("text"))
        .join(F.broadcast(index) if few else index, "key")
    )
    folded = [F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")]
    light = found.where("NOT heavy").select("bucket", "key", "text", "doc_id", F.lit(1).cast("bigint").alias("n"))
    heavy = found.where("heavy").groupBy("bucket", "key", "text").agg(*folded)
    owned = light.unionByName(heavy).repartition("bucket")
    # The owner has a bucket whole, so this needs no exchange; grouping compares the texts' bytes.
    texts = owned.groupBy("bucket", "key", "text").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    links = texts.select("key", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
    chain = Window.partitionBy("key").orderBy(F.col("keep_id").asc_nulls_last(), "text_sha256")
    same = Window.partitionBy("key", "text_sha256")
    twice = F.raise_error(F.lit("two texts of one key have one digest")).cast("int")
    return written(
        links.withColumn("alike", F.count(F.lit(1)).over(same))
        .withColumn("chain", F.when(F.col("alike") > 1, twice).otherwise(F.row_number().over(chain) - 1))
        .drop("alike")
    )


def _answered(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows with the answer of their text, where there is one; those of hot groups stay where they are."""
    names = ["key", "text_sha256"]
    limit = rows.count() // HOT_PARTS
    hot = F.broadcast(answers.where(F.col("group_size") > limit))
    return rows.join(hot, names).unionByName(
        rows.join(hot, names, "left_anti").join(answers.where(F.col("group_size") <= limit), names, "left")
    )
