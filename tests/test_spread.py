"""Tasks by the size of the input."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from stockledger.operators import spread as by_size
from stockledger.operators.spread import spread, tasks_for
from tests.conftest import rows
from tests.test_plans import plan


@pytest.fixture
def large(monkeypatch):
    """Every table counts as one of many tasks."""
    monkeypatch.setattr(by_size, "TASK_BYTES", 1000)


def _dealt(df, *keys):
    """The numbers of tasks that a plan's rows are dealt to by these keys."""
    names = ", ".join(rf"{k}#\d+L?" for k in keys)
    return [int(n) for n in re.findall(rf"hashpartitioning\({names}, (\d+)\), REPARTITION_BY_NUM", plan(df))]


def test_tasks_follow_the_stored_bytes(spark, run_dir, monkeypatch):
    monkeypatch.setattr(by_size, "TASK_BYTES", 500)
    for n, path in ((1, f"{run_dir}/one"), (4, f"{run_dir}/four of it")):
        for _ in range(n):
            spark.range(5000).select(F.xxhash64("id").alias("k")).coalesce(1).write.mode("append").parquet(path)
    one, four = (spark.read.parquet(f"{run_dir}/{p}") for p in ("one", "four of it"))
    assert tasks_for(one) >= 16 and abs(tasks_for(four) - 4 * tasks_for(one)) <= 4
    assert tasks_for(four, four.where("k > 0")) == tasks_for(four)  # a file counts once
    assert tasks_for(four.join(one, "k")) == tasks_for(four, one)
    assert spread(four, 20, "k").rdd.getNumPartitions() == 20
    assert tasks_for(spark.range(10)) is None and tasks_for(spark.readStream.schema("k bigint").parquet(f"{run_dir}/one")) is None


def test_small_tables_are_left_as_they_are(spark, data):
    for name in ("asof_sale_by_category", "asof_sale_rows", "signed_retract_sum"):
        assert "REPARTITION_BY_NUM" not in plan(registered.queries()[name](spark, data))


def test_asof_steps_are_dealt_by_size(spark, data, large, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals, whole = (registered.queries()[n](spark, data) for n in ("asof_sale_by_category", "asof_sale_rows"))
        (n,) = _dealt(totals, "__key", "__bin")
        assert n > 16 and _dealt(totals, "__key") == [n]
        assert len(_dealt(totals, "l_orderkey")) == len(_dealt(totals, "o_orderkey")) == 1
        assert _dealt(whole, "__key", "__bin")
        got = rows(totals), rows(whole)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.undo()
    assert got == tuple(rows(registered.queries()[n](spark, data)) for n in ("asof_sale_by_category", "asof_sale_rows"))


def test_lines_and_orders_are_dealt_by_size(spark, data, large, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        signed = registered.queries()["signed_retract_sum"](spark, data)
        lines, orders = _dealt(signed, "l_orderkey"), _dealt(signed, "o_orderkey")
        assert len(lines) == 2 and min(lines) > 16 and set(orders) == set(lines)
        got = rows(signed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.undo()
    assert got == rows(registered.queries()["signed_retract_sum"](spark, data))
