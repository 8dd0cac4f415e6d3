"""Reading change feeds: files, topics and relational tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.functions import long_from_bytes, strict_long


def read_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    streaming: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A feed landed as files, with its declared schema (nothing is inferred)."""
    reader = (spark.readStream if streaming else spark.read).schema(schema).format(fmt)
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A Kafka topic from its beginning; needs the spark-sql-kafka package on the cluster.

    ``seq`` is the arrival order within a key: a key stays in one partition, so
    the offset orders its records.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    topic_rows = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
        .load()
    )
    return topic_rows.select(
        "key", "value", F.col("timestamp").alias("ts"), F.col("offset").alias("seq")
    )


def json_changes(topic_rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of JSON records. Longs are read as text and must parse."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    fields = topic_rows.select(F.from_json("value", as_text).alias("r"), "ts", "seq")
    return fields.select(
        *[
            (
                strict_long(F.col(f"r.{f.name}"), f.name)
                if isinstance(f.dataType, T.LongType)
                else F.col(f"r.{f.name}").cast(f.dataType)
            ).alias(f.name)
            for f in schema
            if f.name not in ("ts", "seq")
        ],
        "ts",
        "seq",
    )


def long_pairs(topic_rows: DataFrame) -> DataFrame:
    """Records of a topic of longs, as this library publishes them."""
    return topic_rows.select(
        long_from_bytes("key").alias("key"), long_from_bytes("value").alias("value"), "ts", "seq"
    )


@dataclass(frozen=True)
class JdbcTable:
    """A relational table with a growing id, read in parallel ranges of that id."""

    url: str
    table: str
    id_column: str
    partitions: int = 64
    properties: Mapping[str, str] | None = None

    def options(self, low: int, high: int, after: int | None = None) -> dict[str, str]:
        """Reader options for ids ``low`` to ``high``, rows after the high-water mark only."""
        table = self.table
        if after is not None:
            table = f"(SELECT * FROM {self.table} WHERE {self.id_column} > {int(after)}) pulled"
            low = max(low, after + 1)
        return {
            **(self.properties or {}),
            "url": self.url,
            "dbtable": table,
            "partitionColumn": self.id_column,
            "lowerBound": str(low),
            "upperBound": str(max(high, low) + 1),
            "numPartitions": str(self.partitions),
        }

    def read(self, spark: SparkSession, low: int, high: int, after: int | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(low, high, after)).load()


def pull_after(table: DataFrame, id_column: str, seen: DataFrame) -> DataFrame:
    """The rows of a table added since the rows already ``seen``.

    The high-water mark is a scalar subquery, so it is computed inside the query
    and filters the scan; with nothing seen yet all rows are pulled.
    """
    mark = seen.select(F.max(id_column)).scalar()
    return table.where(mark.isNull() | (F.col(id_column) > mark))
