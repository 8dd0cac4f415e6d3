"""Hand cases and brute force for the operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stockledger.operators import (
    asof_lookup,
    asof_totals,
    interval_left_join,
    interval_left_sum,
    latest_by_key,
    reduce_by_key,
    signed_join,
    snapshot_lookup,
    spine_totals,
    windowed_total,
    zero_filled,
)
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def _at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def test_spine_keeps_its_keys_and_zero_fills(spark):
    spine = spark.createDataFrame([(1, 0), (2, 0)], "k bigint, seq bigint")
    facts = spark.createDataFrame([(1, 5), (1, -3), (9, 4)], "k bigint, q bigint")
    totals = spine_totals(spine, facts, "k", ["q"])
    assert rows(totals, "k", "q") == [(1, 2), (2, None), (9, 4)]
    assert rows(zero_filled(totals, "k", ["q"])) == [(1, 2), (2, 0)]


def test_spine_takes_the_latest_attribute(spark):
    spine = spark.createDataFrame([(1, 7, "old"), (1, 9, "new")], "k bigint, seq bigint, n string")
    facts = spark.createDataFrame([(1, 5)], "k bigint, q bigint")
    assert rows(spine_totals(spine, facts, "k", ["q"], ["n"])) == [(1, 9, "new", 5)]


def test_overflow_fails(spark):
    facts = spark.createDataFrame([(1, 2**63 - 1), (1, 1)], "k bigint, q bigint")
    spine = spark.createDataFrame([(1, 0)], "k bigint, seq bigint")
    with pytest.raises(PySparkException, match="(?i)overflow"):
        spine_totals(spine, facts, "k", ["q"]).collect()


def test_signed_join_is_a_left_join_chain(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k bigint, q bigint")
    b = spark.createDataFrame([(1, 3), (5, 7)], "k bigint, q bigint")
    c = spark.createDataFrame([(2, 4)], "k bigint, q bigint")
    assert rows(signed_join(a, [(-1, b), (1, c)], "k", "q")) == [(1, 7), (2, 24)]
    with pytest.raises(ValueError):
        signed_join(a, [(2, b)], "k", "q")


def test_latest_and_reduce(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, 1), (1, "b", 2, 3), (1, "c", 9, 2)], "k bigint, n string, v bigint, seq bigint"
    )
    assert rows(latest_by_key(df, "k", ["n", "v"])) == [(1, "b", 2)]
    reduced = reduce_by_key(df, "k", "v", ["sum", "min", "max", "latest"])
    assert rows(reduced) == [(1, 16, 2, 9, 2)]
    with pytest.raises(ValueError):
        reduce_by_key(df, "k", "v", "median")


def test_snapshot_lookup_keeps_all_columns(spark):
    facts = spark.createDataFrame([(1, 5, 0), (2, 7, 1), (None, 9, 2)], "item bigint, q bigint, salt bigint")
    latest = spark.createDataFrame([(1, 10), (None, 11)], "item bigint, category bigint")
    found = snapshot_lookup(facts, latest, "item", default=999999)
    want = [(1, 5, 0, 10), (2, 7, 1, 999999), (None, 9, 2, 999999)]
    assert rows(found, "item", "q", "salt", "category") == want


CHANGES = [(1, 10, _at(10), 1), (1, 20, _at(20), 3), (1, 15, _at(20), 2), (3, 30, _at(0), 4)]


def test_asof_hand_cases(spark):
    changes = spark.createDataFrame(CHANGES, "item bigint, cat bigint, ts timestamp, seq bigint")
    facts = spark.createDataFrame(
        [(1, _at(5)), (1, _at(10)), (1, _at(15)), (1, _at(20)), (1, _at(9999)), (2, _at(5))],
        "item bigint, ts timestamp",
    )
    got = asof_lookup(facts, changes, "item", "cat", 999999)
    assert rows(got, "item", "ts", "cat") == [
        (1, _at(5), 999999),
        (1, _at(10), 10),
        (1, _at(15), 10),
        (1, _at(20), 20),
        (1, _at(9999), 20),
        (2, _at(5), 999999),
    ]


@pytest.mark.parametrize("bucket", [timedelta(minutes=1), timedelta(hours=1), timedelta(days=9)])
def test_asof_against_brute_force_with_a_hot_key(spark, bucket):
    """One item holds a third of facts and changes, one instant a third of its facts."""
    rng = random.Random(5)
    item = lambda: 1 if rng.random() < 0.34 else rng.randrange(2, 12)
    when = lambda: _at(77) if rng.random() < 0.34 else _at(rng.randrange(0, 6000) / 10)
    changes = [(item(), rng.randrange(5), when(), seq) for seq in range(120)]
    facts = [(item(), when(), rng.randrange(100)) for _ in range(600)]
    want: dict[int, int] = {}
    for i, ts, q in facts:
        seen = [(t, seq, c) for j, c, t, seq in changes if j == i and t <= ts]
        category = max(seen)[2] if seen else 999999
        want[category] = want.get(category, 0) + q
    c = spark.createDataFrame(changes, "item bigint, cat bigint, ts timestamp, seq bigint")
    f = spark.createDataFrame(facts, "item bigint, ts timestamp, q bigint")
    got = asof_totals(f, c, "item", "cat", ["q"], 999999, bucket=bucket)
    assert dict(rows(got)) == want
    by_row = asof_lookup(f, c, "item", "cat", 999999, bucket=bucket)
    assert by_row.count() == len(facts)
    assert dict(rows(by_row.groupBy("cat").agg(F.sum("q")))) == want


def test_unknown_facts_join_a_real_category_of_that_id(spark):
    changes = spark.createDataFrame(
        [(1, 999999, _at(0), 1)], "item bigint, cat bigint, ts timestamp, seq bigint"
    )
    facts = spark.createDataFrame([(1, _at(1), 5), (2, _at(1), 7)], "item bigint, ts timestamp, q bigint")
    assert rows(asof_totals(facts, changes, "item", "cat", ["q"], 999999)) == [(999999, 12)]


@pytest.mark.parametrize("bucket", [1, 12, 1000])
def test_asof_null_changes_and_null_keys(spark, bucket):
    """A change to null holds until the next; a null key has no changes."""
    changes = spark.createDataFrame(
        [(1, 10, 10, 1), (1, None, 20, 2), (None, 77, 0, 3)], "item bigint, cat bigint, at bigint, seq bigint"
    )
    facts = spark.createDataFrame(
        [(1, 15, 7), (1, 30, 5), (None, 30, 3)], "item bigint, at bigint, q bigint"
    )
    totals = asof_totals(facts, changes, "item", "cat", ["q"], 999999, ts="at", bucket=bucket)
    assert dict(rows(totals)) == {10: 7, 999999: 8}
    found = asof_lookup(facts, changes, "item", "cat", 999999, ts="at", bucket=bucket)
    assert rows(found, "q", "cat") == [(3, 999999), (5, 999999), (7, 10)]


def test_asof_buckets_are_whole_numbers(spark):
    """Nanosecond orders beyond what a double tells apart, at the edges of one-second buckets."""
    edge, width = 1_700_000_000 * 10**9, 10**9
    changes = spark.createDataFrame([(1, 10, edge - 2, 1), (2, 20, -edge - 2, 1)], "item bigint, cat bigint, at bigint, seq bigint")
    facts = spark.createDataFrame(
        [(1, edge - 1, 1), (1, edge, 2), (1, edge - 3, 3), (2, -edge - 1, 4), (2, -edge, 5)],
        "item bigint, at bigint, q bigint",
    )
    found = asof_lookup(facts, changes, "item", "cat", 0, ts="at", bucket=width)
    assert rows(found, "q", "cat") == [(1, 10), (2, 10), (3, 0), (4, 20), (5, 20)]
    totals = asof_totals(facts, changes, "item", "cat", ["q"], 0, ts="at", bucket=width)
    assert dict(rows(totals)) == {10: 3, 0: 3, 20: 9}


def _timed(spark, values):
    return spark.createDataFrame(values, "k bigint, ts timestamp, v bigint")


def test_interval_ends_are_inclusive(spark):
    left = _timed(spark, [(1, _at(100), 1), (2, _at(100), 2)])
    right = _timed(
        spark,
        [(1, _at(50), 10), (1, _at(150), 20), (1, _at(49.999), 30), (1, _at(150.001), 40), (3, _at(100), 50)],
    )
    pairs = interval_left_join(left, right, "k")
    assert rows(pairs, "k", "v", "right_v") == [(1, 1, 10), (1, 1, 20), (2, 2, None)]
    assert rows(interval_left_sum(left, right, "k", "v")) == [(1, 30), (2, 0)]


def test_interval_null_keys_pair_with_nothing(spark):
    left, right = _timed(spark, [(None, _at(1), 1)]), _timed(spark, [(None, _at(1), 7)])
    assert rows(interval_left_join(left, right, "k"), "v", "right_v") == [(1, None)]
    assert rows(interval_left_sum(left, right, "k", "v")) == [(None, 0)]
    hidden = left.withColumn("right_v", F.lit(1))
    with pytest.raises(ValueError, match="hidden"):
        interval_left_join(hidden, right, "k")
    mine = left.withColumn("salt", F.lit(1)).withColumn("bucket", F.lit(2))
    assert {"salt", "bucket"} <= set(interval_left_join(mine, right, "k", salts=2).columns)


def test_spine_and_facts_need_their_keys_and_order(spark):
    spine = spark.createDataFrame([(1, None)], "k bigint, seq bigint")
    facts = spark.createDataFrame([(1, 5)], "k bigint, q bigint")
    with pytest.raises(PySparkException, match="seq must not be null"):
        spine_totals(spine, facts, "k", ["q"]).collect()


def test_interval_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(11)
    key = lambda: 1 if rng.random() < 0.34 else rng.randrange(2, 9)
    left = [(key(), _at(rng.randrange(0, 600)), n) for n in range(150)] + [(1, _at(300), 7)] * 40
    right = [(key(), _at(rng.randrange(0, 600)), n) for n in range(150)] + [(1, _at(310), 9)] * 40
    reach = timedelta(minutes=50)
    want, sums = [], {}
    for k, ts, v in left:
        near = [w for j, t, w in right if j == k and abs(t - ts) <= reach]
        want += [(k, v, w) for w in near or [None]]
        sums[k] = sums.get(k, 0) + sum(near)
    want.sort(key=lambda r: tuple((x is None, x) for x in r))
    for salts in (1, 3):
        pairs = interval_left_join(_timed(spark, left), _timed(spark, right), "k", salts=salts)
        assert rows(pairs, "k", "v", "right_v") == want
    assert dict(rows(interval_left_sum(_timed(spark, left), _timed(spark, right), "k", "v"))) == sums


def test_windows(spark):
    df = _timed(spark, [(1, _at(0), 5), (1, _at(59.99), 6), (1, _at(60), 7)])
    tumbling = windowed_total(df, "k", "ts", "1 hour", value="v")
    assert rows(tumbling, "k", "window_start", "total") == [(1, _at(0), 11), (1, _at(60), 7)]
    hopping = windowed_total(df, "k", "ts", "2 hours", "1 hour")
    assert rows(hopping, "window_start", "total") == [(_at(-60), 2), (_at(0), 3), (_at(60), 1)]
