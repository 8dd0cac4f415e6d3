"""Where streaming state is kept."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on executor disks rather than in their heap, and upload only its changes.

    Totals hold one row per key for good, so state grows with the number of keys.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
