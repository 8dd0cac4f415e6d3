import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.schemas import ITEM
from stockledger.sources.changes import (
    JdbcTable,
    json_changes,
    long_pairs,
    pull_after,
    read_changes,
)
from stockledger.sources.sinks import json_documents, topic_records
from tests.conftest import rows


def test_feed_files_in_batch_and_stream(spark, run_dir):
    df = spark.createDataFrame([(1, 10, None, 1)], ITEM)
    df.write.parquet(f"{run_dir}/item")
    assert rows(read_changes(spark, f"{run_dir}/item", ITEM, streaming=False)) == [(1, 10, None, 1)]
    stream = read_changes(spark, f"{run_dir}/item", ITEM, files_per_batch=1)
    assert stream.isStreaming and stream.schema == ITEM


def test_jdbc_ranges_and_high_water_mark():
    table = JdbcTable("jdbc:db://host/shop", "sale_event", "id", 8, {"user": "u"})
    assert table.options(1, 100) == {
        "user": "u",
        "url": "jdbc:db://host/shop",
        "dbtable": "sale_event",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "101",
        "numPartitions": "8",
    }
    later = table.options(1, 100, after=60)
    assert later["dbtable"] == "(SELECT * FROM sale_event WHERE id > 60) pulled"
    assert (later["lowerBound"], later["upperBound"]) == ("61", "101")


def test_pull_after(spark):
    table = spark.createDataFrame([(n,) for n in range(1, 6)], "id bigint")
    assert rows(pull_after(table, "id", table.where("id <= 3"))) == [(4,), (5,)]
    assert len(rows(pull_after(table, "id", table.where("id > 9")))) == 5
    assert rows(pull_after(table, "id", table)) == []


def _records(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.select("value", F.current_timestamp().alias("ts"), F.lit(1).alias("seq"))


def test_json_records(spark):
    schema = T.StructType.fromDDL("item_id bigint, name string")
    good = json_changes(_records(spark, '{"item_id": 5, "name": "a"}', '{"item_id": "6"}'), schema)
    assert rows(good, "item_id", "name") == [(5, "a"), (6, None)]
    for bad in ('{"item_id": "x"}', '{"name": "a"}', '{"item_id": 6.5}', "nonsense"):
        with pytest.raises(PySparkException, match="item_id is not a whole number"):
            json_changes(_records(spark, bad), schema).collect()


def test_topic_of_longs_and_documents(spark):
    pairs = spark.createDataFrame([(1, -2), (3, 4)], "key bigint, value bigint")
    sent = topic_records(pairs).select("*", F.current_timestamp().alias("ts"), F.lit(0).alias("seq"))
    assert rows(long_pairs(sent), "key", "value") == [(1, -2), (3, 4)]
    assert rows(json_documents(pairs)) == [('{"key":1,"value":-2}',), ('{"key":3,"value":4}',)]
