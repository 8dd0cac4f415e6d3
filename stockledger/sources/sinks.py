"""What published rows look like, and the streaming writers that send them on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockledger.functions import long_to_bytes, or_unknown
from stockledger.operators.keyed import latest_by_key
from stockledger.plans.ledger import Ledger, total_value
from stockledger.schemas import TOTAL_NAMES


def latest_of_changes(changes: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The table a change log describes: the newest batch's row of every key."""
    return latest_by_key(changes, key, values, order="batch_id")


def topic_records(pairs: DataFrame) -> DataFrame:
    """(key, value) longs as the bytes a topic of longs carries; a topic column is kept."""
    topic = [c for c in pairs.columns if c == "topic"]
    coded = [long_to_bytes(c).alias(c) for c in ("key", "value")]
    return pairs.select(*topic, *coded)


def published(totals: DataFrame, table: str, key: str) -> DataFrame:
    """Wide totals, batch or stream, as (topic, key, value) rows of their public topics.

    One pass over the totals feeds all topics of the table. Keys the dimension lacks
    are not published.
    """
    entries = [
        F.struct(F.lit(f"{name}-topic").alias("topic"), total_value(column).alias("value"))
        for name, (of, column) in TOTAL_NAMES.items()
        if of == table
    ]
    known = totals.where(F.col("seq").isNotNull())
    return known.select(F.col(key).alias("key"), F.explode(F.array(*entries)).alias("entry")).select(
        "entry.topic", "key", "entry.value"
    )


def published_stock(ledger: Ledger) -> DataFrame:
    """The topics of the by-item and the by-category totals, (topic, key, value), from one pass of the facts.

    A category's totals are sums of its items', so every item's row is turned into its own topics' values and its share of its category's,
    and both are summed per topic and key beside the dimension's marks. One more exchange, of a few values an item.
    """
    items, known = ledger.categorised_items(), F.col("seq").isNotNull()

    def entries(table: str, key, mark) -> list:
        return [
            F.struct(
                F.lit(f"{name}-topic").alias("topic"), key.alias("key"),
                total_value(column).alias("value"), mark.alias("known"),
            )
            for name, (of, column) in TOTAL_NAMES.items()
            if of == table
        ]

    own = entries("item_totals", F.col("item_id"), known)
    shares = entries("category_totals", or_unknown("category_id"), F.lit(False))
    rows = items.select(F.explode(F.array(*own, *shares)).alias("e")).select("e.*")
    none = F.lit(0).cast("bigint")
    names = F.array(*[F.lit(f"{n}-topic") for n, (of, _) in TOTAL_NAMES.items() if of == "category_totals"])
    marks = ledger.feeds.category.select(
        F.explode(names).alias("topic"), F.col("category_id").alias("key"), none.alias("value"), F.lit(True).alias("known")
    )
    return (
        rows.unionByName(marks)
        .groupBy("topic", "key")
        .agg(F.sum("value").alias("value"), F.max("known").alias("known"))
        .where("known")
        .drop("known")
    )


def json_documents(rows: DataFrame) -> DataFrame:
    """Each row as one JSON document."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("document"))


def to_topics(
    pairs: DataFrame, servers: str, checkpoint: str, topic: str | None = None, **trigger
) -> StreamingQuery:
    """Publish a stream of changed (key, value) rows to Kafka (needs spark-sql-kafka).

    All to one ``topic``, or each to the one its topic column names.
    """
    named = {"topic": topic} if topic else {}
    return (
        topic_records(pairs)
        .writeStream.format("kafka")
        .outputMode("update")
        .option("kafka.bootstrap.servers", servers)
        .options(**named)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def to_index(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "org.elasticsearch.spark.sql",
    options: Mapping[str, str] | None = None,
    **trigger,
) -> StreamingQuery:
    """Append every change to a search index as a document of its own.

    No document id is set, so an index keeps all versions of a key. File formats
    get one directory per batch, which a repeated batch overwrites.
    """
    is_files = fmt in ("json", "parquet", "text")

    def write(rows: DataFrame, batch_id: int) -> None:
        out = rows.write.format(fmt).options(**(options or {}))
        if is_files:
            out.mode("overwrite").save(f"{path}/batch_id={batch_id}")
        else:
            out.mode("append").save(path)

    return (
        changes.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def to_console(changes: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        changes.writeStream.outputMode("update")
        .format("console")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
