"""Shape of the plans: what must hold for them to carry over to large data."""

import pathlib
import re

import pytest

import __spark_entry__ as registered
from stockledger.plans import Ledger
from stockledger.sources.tables import OrderTables

QUERIES = registered.queries()
RUNS_STREAMS = ("stream_", "changelog_", "lookup_by", "scan_all", "key_range", "window_fetch")
BATCH = sorted(n for n in registered.QUERIES if not n.startswith(RUNS_STREAMS))
LIBRARY = pathlib.Path(registered.__file__).parent / "stockledger"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_no_product_no_nested_loop_no_python(spark, data, no_auto_broadcast, name):
    shown = plan(QUERIES[name](spark, data))
    for node in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert node not in shown


@pytest.mark.parametrize(
    "name, key",
    [("items_at_hand", "item_id"), ("items_with_customer", "customer_id")],
)
def test_totals_shuffle_once_after_a_partial_aggregate(spark, data, name, key):
    """With orders broadcast, the only exchange of facts is that of the one aggregate."""
    shown = plan(getattr(Ledger(OrderTables(spark, data).feeds()), name)())
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", shown)
    assert exchanges == [key]
    assert shown.count("HashAggregate") == 2 and "SortAggregate" not in shown


def test_category_totals_add_one_small_exchange(spark, data):
    shown = plan(Ledger(OrderTables(spark, data).feeds()).items_at_hand_by_category())
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", shown)
    # Totals by category, the distinct sizes that make the categories, totals by item.
    assert sorted(exchanges) == ["category_id", "category_id", "item_id"]
    assert "Join" not in shown.replace("BroadcastHashJoin [l_orderkey", "")


def test_large_sides_are_joined_once(spark, data, no_auto_broadcast):
    shown = plan(Ledger(OrderTables(spark, data).feeds()).items_at_hand())
    assert shown.count("SortMergeJoin") == 1


def test_scans_read_the_columns_they_need(spark, data):
    shown = plan(QUERIES["q1_replenished_by_item"](spark, data))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", shown)
    assert sorted(schemas) == [
        "l_partkey:bigint,l_linenumber:int,l_quantity:double",
        "p_partkey:bigint",
    ]
    assert "EqualTo(l_linenumber,1)" in shown


def test_asof_scans_the_facts_once(spark, data):
    shown = plan(QUERIES["asof_sale_by_category"](spark, data))
    assert shown.count("lineitem.parquet") == 1
    assert "Join" not in shown.replace("BroadcastHashJoin [l_orderkey", "")


def test_asof_rows_scan_the_facts_twice(spark, data, no_auto_broadcast):
    """Once for the instants, whose exchange both of its readers share, and once for the rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it runs, without running it
    try:
        shown = plan(QUERIES["asof_sale_rows"](spark, data))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert shown.count("lineitem.parquet") == 2


def test_two_readings_of_a_join_are_one(spark, data, no_auto_broadcast):
    shown = plan(QUERIES["read_changes_count"](spark, data))
    assert shown.count("SortMergeJoin") == 1


def test_planning_runs_no_job_and_salts_are_repeatable(spark, data, no_auto_broadcast):
    spark.sparkContext.setJobGroup("planning", "")
    for name in ("sale_snapshot_category", "asof_sale_rows", "asof_sale_by_category", "interval_left_join_salted"):
        assert "rand(" not in plan(QUERIES[name](spark, data))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")


def test_as_wired_totals_read_the_lines_once(spark, data, no_auto_broadcast):
    shown = plan(QUERIES["q11_as_wired"](spark, data))
    assert shown.count("SortMergeJoin") == 1


def test_reads_push_their_keys_into_the_snapshot(spark, data):
    df = QUERIES["key_range"](spark, data)
    assert any("/snapshot/" in f for f in df.inputFiles())
    assert plan(df).count("GreaterThanOrEqual(key,100)") == 2


def test_a_lookup_joins_on_its_own_exchanges(spark, data, no_auto_broadcast):
    """Right above both exchanges, where adaptive execution may split what is hot."""
    shown = plan(QUERIES["sale_snapshot_category"](spark, data))
    assert len(re.findall(r"Exchange hashpartitioning\(item_id#", shown)) >= 1


def test_library_collects_nothing():
    for path in LIBRARY.rglob("*.py"):
        if "llm" in path.parts:
            continue
        text = path.read_text()
        for call in (".collect(", ".toPandas(", ".toLocalIterator(", ".rdd", "localCheckpoint"):
            assert call not in text, f"{call} in {path}"
