"""Kept tables: logs, views, snapshots, named reads."""

import pytest

from stockledger.sources import reads
from stockledger.sources.kept import KeptTables, shared_dir
from tests.conftest import rows

WIDE = "key bigint, seq bigint, replenished bigint, sold bigint, returned bigint"


def _publish(spark, tables, batch_id, values, table="item_totals", schema=WIDE):
    tables.publish(table, spark.createDataFrame(values, schema), batch_id)


@pytest.fixture
def tables(spark, run_dir):
    tables = KeptTables(spark, run_dir, epoch=2)
    _publish(spark, tables, 0, [(1, 1, 10, None, None), (2, 1, None, 5, None)])
    _publish(spark, tables, 1, [(1, 1, 10, 4, 1), (9, None, 3, None, None)])
    return tables


def test_view_is_the_latest_row_per_key(tables):
    assert rows(tables.view("item_totals"), "key", "replenished", "sold") == [
        (1, 10, 4), (2, None, 5), (9, 3, None),
    ]
    assert tables.changes("item_totals").count() == 4


def test_a_repeated_batch_changes_nothing(spark, tables):
    before = rows(tables.view("item_totals"))
    _publish(spark, tables, 1, [(1, 1, 10, 4, 1), (9, None, 3, None, None)])
    assert rows(tables.view("item_totals")) == before
    assert tables.changes("item_totals").count() == 4


def test_batches_without_files_are_not_read(spark, tables, run_dir):
    import os

    os.makedirs(f"{run_dir}/item_totals/changes/batch_id=2/_temporary")
    assert tables.last_batch("item_totals") == 1


def test_an_absent_earlier_batch_fails(spark, tables):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.view_before("item_totals", 4, WIDE)


def test_success_markers_are_not_needed(spark, run_dir):
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark.conf.set(name, "false")
    try:
        tables = KeptTables(spark, run_dir, epoch=2)
        for n in range(5):
            _publish(spark, tables, n, [(n, 1, n, None, None)])
        assert len(rows(tables.view("item_totals"))) == 5
        assert len(rows(tables.view_before("item_totals", 4, WIDE))) == 4
    finally:
        spark.conf.unset(name)


def test_epochs_are_sealed_and_read(spark, tables):
    before = rows(tables.view("item_totals"))
    _publish(spark, tables, 2, [(2, 1, None, 6, None)])
    assert rows(reads.by_key(tables.view("item_totals"), 2), "sold") == [(6,)]
    _publish(spark, tables, 3, [(2, 1, None, 7, None)])
    _publish(spark, tables, 4, [(2, 1, None, 8, None)])
    assert rows(tables.view("item_totals"), "key", "sold") == [(1, 4), (2, 8), (9, None)]
    assert rows(tables.view_before("item_totals", 2, WIDE)) == before
    _publish(spark, tables, 4, [(2, 1, None, 8, None)])
    assert tables.last_batch("item_totals") == 4
    assert tables.changes("item_totals").count() == 7


def test_named_reads(spark, tables):
    assert rows(tables.named("refill-qty-by-item-store")) == [(1, 10), (2, 0)]
    assert rows(tables.named("refill-qty-by-item-topic")) == [(1, 10), (2, 0)]
    assert rows(tables.named("refill-qty-by-item-store-0.9")) == [(1, 10), (2, 0)]
    assert rows(tables.named("refill-qty-by-item-store-0.8")) == [(1, 10), (9, 3)]
    assert rows(tables.named("items-at-hand-store")) == [(1, 7), (2, -5)]
    _publish(spark, tables, 0, [(4, "ann", 2)], "customer_latest", "key bigint, name string, seq bigint")
    assert rows(tables.named("customer-store")) == [(4, "ann")]
    for unknown in ("items-at-hand-store-0.8", "nothing-store", "items-at-hand"):
        with pytest.raises(KeyError):
            tables.named(unknown)
    with pytest.raises(ValueError, match="nothing has been published"):
        tables.view("category_totals")


def test_reads(spark, run_dir):
    tables = KeptTables(spark, run_dir)
    _publish(spark, tables, 0, [(k, k * 10) for k in range(1, 10)], "t", "key bigint, value bigint")
    view = tables.view("t")
    assert rows(reads.by_key(view, 4)) == [(4, 40)]
    assert rows(reads.by_key(view, 44)) == []
    assert rows(reads.key_range(view, 3, 7), "key") == [(3,), (4,), (5,), (6,), (7,)]
    assert len(rows(view)) == 9


def test_key_filters_reach_the_scan(spark, tables):
    _publish(spark, tables, 2, [(2, 1, None, 6, None)])
    plan = reads.key_range(tables.view("item_totals"), 3, 7)._jdf.queryExecution().toString()
    assert plan.count("PushedFilters: [IsNotNull(key), GreaterThanOrEqual(key,3)") == 2


def test_window_fetch_ends_are_inclusive(spark):
    windows = spark.sql(
        "SELECT 'a' AS k, timestamp_millis(n * 1000) AS window_start, n AS total"
        " FROM range(1, 6) AS t(n) UNION ALL SELECT 'b', timestamp_millis(2000), 7L"
    )
    assert rows(reads.window_fetch(windows, "k", "a", 2000, 4000)) == [(2000, 2), (3000, 3), (4000, 4)]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark).startswith("/tmp/run-")
    assert KeptTables(spark).root == shared_dir(spark) + "/kept"
