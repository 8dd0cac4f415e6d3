"""Streams give the batch answer, whatever the batches, and survive a restart."""

import os
import random
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stockledger.functions import long_from_bytes
from stockledger.operators import interval_left_join, windowed_total
from stockledger.plans import GivenFeeds, Ledger
from stockledger.schemas import CATEGORY, CUSTOMER, ITEM, REPLENISHMENT, RETURN, SALE
from stockledger.sources import reads
from stockledger.sources.changes import read_changes
from stockledger.sources.kept import KeptTables
from stockledger.sources.sinks import json_documents, published, to_index, topic_records
from stockledger.streaming import (
    category_totals_at_arrival,
    keep,
    keep_category_totals,
    keep_windows,
    latest_names,
)
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
NAMES = {
    "item": ITEM,
    "customer": CUSTOMER,
    "category": CATEGORY,
    "replenishment": REPLENISHMENT,
    "sale": SALE,
    "ret": RETURN,
}


class Log:
    """Six feeds as directories of small files, each file one arrival."""

    def __init__(self, spark, root):
        self.spark, self.root, self.seq, self.rows = spark, root, 0, {n: [] for n in NAMES}
        self.files = 0
        for n in NAMES:
            self._write(n, [])

    def _write(self, name, values):
        os.makedirs(f"{self.root}/{name}", exist_ok=True)
        schema = to_arrow_schema(NAMES[name])
        columns = list(zip(*values, strict=True)) or [()] * len(schema)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        self.files += 1
        pq.write_table(pa.table(arrays, schema), f"{self.root}/{name}/{self.files:04}.parquet")

    def add(self, **feeds):
        """One file per named feed; every row gets the next arrival number."""
        for name, values in feeds.items():
            stamped = []
            for value in values:
                self.seq += 1
                stamped.append((*value, T0 + timedelta(minutes=self.seq), self.seq))
            self.rows[name] += stamped
            self._write(name, stamped)

    def stream(self, files_per_batch=None):
        return GivenFeeds(
            **{
                n: read_changes(
                    self.spark, f"{self.root}/{n}/*.parquet", s, files_per_batch=files_per_batch
                )
                for n, s in NAMES.items()
            }
        )

    def batch(self):
        return GivenFeeds(
            **{n: self.spark.createDataFrame(self.rows[n], s) for n, s in NAMES.items()}
        )


def _finish(query):
    assert query.awaitTermination(120)


@pytest.fixture
def log(spark, run_dir):
    log = Log(spark, f"{run_dir}/feeds")
    rng = random.Random(3)
    item = lambda: 1 if rng.random() < 0.34 else rng.randrange(1, 8)
    for _ in range(3):
        log.add(
            sale=[(item(), rng.randrange(4), rng.randrange(9)) for _ in range(8)],
            item=[(item(), rng.choice([10, 20, 30])) for _ in range(3)],
            replenishment=[(item(), rng.randrange(50)) for _ in range(4)],
            customer=[(rng.randrange(4), f"name {rng.random()}") for _ in range(2)],
            category=[(rng.choice([10, 20, 40]), "c")],
            ret=[(item(), rng.randrange(4), rng.randrange(3)) for _ in range(3)],
        )
    return log


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_item_and_customer_totals_equal_batch(spark, log, run_dir, files_per_batch):
    tables = KeptTables(spark, f"{run_dir}/kept")
    live, batch = Ledger(log.stream(files_per_batch)), Ledger(log.batch())
    kept = [
        (live.item_totals(attributes=["category_id"]), "item_totals", "item_id"),
        (live.customer_totals(), "customer_totals", "customer_id"),
        (latest_names(live.feeds.customer, "customer_id"), "customer_latest", "customer_id"),
    ]
    for total, table, key in kept:
        _finish(
            keep(total, tables, table, key, f"{run_dir}/{table}", availableNow=True)
        )
    assert rows(tables.named("refill-qty-by-item-store")) == rows(batch.replenished_by_item())
    assert rows(tables.named("sale-qty-by-item-store")) == rows(batch.sold_by_item())
    assert rows(tables.named("items-at-hand-store")) == rows(batch.items_at_hand())
    assert rows(tables.named("sale-qty-by-item-store-0.8")) == rows(batch.raw_by_item("sold"))
    assert rows(tables.named("items-with-cust-store")) == rows(batch.items_with_customer())
    newest = {c: n for c, n, _, _ in log.rows["customer"]}
    assert dict(rows(tables.named("customer-store"))) == newest
    assert dict(rows(tables.named("item-store"))) == {i: c for i, c, _, _ in log.rows["item"]}


def _keyed_state(log, tables, run_dir):
    live = category_totals_at_arrival(log.stream(), salts=3)
    _finish(keep(live, tables, "category_totals", "category_id", f"{run_dir}/c", availableNow=True))


def _whole_batches(log, tables, run_dir, **more):
    live = keep_category_totals(
        log.stream(), tables, f"{run_dir}/c", availableNow=True, **more
    )
    _finish(live)


def _small_buckets(log, tables, run_dir):
    _whole_batches(log, tables, run_dir, bucket=2)


ALL_WAYS = pytest.mark.parametrize("run", [_keyed_state, _whole_batches, _small_buckets])


@ALL_WAYS
def test_category_at_arrival_equals_replay(spark, log, run_dir, run):
    tables = KeptTables(spark, f"{run_dir}/kept")
    run(log, tables, run_dir)
    assert _totals(tables) == _replayed(log)


@ALL_WAYS
def test_category_at_arrival_over_several_batches(spark, run_dir, run):
    """The hand case: sales before, between and after an item's changes, a batch each."""
    log, tables = Log(spark, f"{run_dir}/feeds"), KeptTables(spark, f"{run_dir}/kept")
    steps = [
        dict(category=[(10, "ten"), (20, "twenty"), (999999, "rest")], sale=[(1, 7, 5)]),
        dict(item=[(1, 10)], sale=[(1, 7, 7)]),
        dict(item=[(1, 20)]),
        dict(sale=[(1, 7, 9), (2, 7, 4)]),
    ]
    for step in steps:
        log.add(**step)
        run(log, tables, run_dir)
    assert _totals(tables) == _replayed(log)
    assert dict(rows(tables.named("sale-qty-by-cat-store"))) == {10: 7, 20: 9, 999999: 9}
    snapshot = Ledger(log.batch()).sold_by_category()
    assert dict(rows(snapshot)) == {10: 0, 20: 21, 999999: 4}


def test_a_repeated_batch_of_category_totals_adds_nothing(spark, log, run_dir):
    tables = KeptTables(spark, f"{run_dir}/kept")
    _whole_batches(log, tables, run_dir)
    log.add(sale=[(1, 0, 5)], item=[(1, 30)])
    _whole_batches(log, tables, run_dir)
    _lose_last_commit(f"{run_dir}/c")
    _whole_batches(log, tables, run_dir)
    assert _totals(tables) == _replayed(log)


def _lose_last_commit(checkpoint):
    commits = [n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()]
    last = max(commits, key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")


def _totals(tables):
    view = tables.view("category_totals").where("seq IS NOT NULL")
    return rows(view.na.fill(0), "key", "replenished", "sold", "returned")


def _replayed(log):
    """All records in arrival order, one by one."""
    records = [(r[-1], name, r) for name in NAMES for r in log.rows[name]]
    category, totals, known = {}, {}, set()
    kinds = {"replenishment": 0, "sale": 1, "ret": 2}
    for _, name, r in sorted(records, key=lambda x: x[0]):
        if name == "item":
            category[r[0]] = r[1]
        elif name == "category":
            known.add(r[0])
        elif name in kinds:
            sums = totals.setdefault(category.get(r[0], 999999), [0, 0, 0])
            sums[kinds[name]] += r[-3]
    return sorted((c, *totals.get(c, (0, 0, 0))) for c in known)


def test_restart_counts_nothing_twice(spark, log, run_dir):
    """Stop after some batches, lose the last batch's commit, go on with the same checkpoint."""
    tables = KeptTables(spark, f"{run_dir}/kept")

    def go_on():
        live = Ledger(log.stream(1)).item_totals()
        _finish(keep(live, tables, "item_totals", "item_id", f"{run_dir}/c", availableNow=True))

    go_on()
    before = rows(tables.named("items-at-hand-store"))
    _lose_last_commit(f"{run_dir}/c")
    go_on()
    assert rows(tables.named("items-at-hand-store")) == before
    log.add(sale=[(1, 0, 1000)], item=[(1, 10)])
    go_on()
    assert rows(tables.named("items-at-hand-store")) == rows(Ledger(log.batch()).items_at_hand())


def _events(spark, root, batches):
    schema = "k bigint, ts timestamp, v bigint"
    for values in batches:
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(root)
    return lambda: (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(root)
    )


def _at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_windows_with_a_watermark_drop_late_rows(spark, run_dir):
    stream = _events(
        spark,
        f"{run_dir}/in",
        # A batch is checked against the watermark its predecessor started with.
        [
            [(1, _at(5), 1)],
            [(1, _at(300), 2)],
            [(1, _at(301), 3)],
            [(1, _at(6), 100)],
            [(1, _at(310), 4)],
        ],
    )
    tables = KeptTables(spark, f"{run_dir}/kept")
    live = windowed_total(stream(), "k", "ts", "1 hour", value="v", late="30 minutes")
    _finish(keep_windows(live, tables, "w", "k", f"{run_dir}/c", availableNow=True))
    windows = tables.windows("w")
    assert rows(windows, "key", "window_start", "total") == [(1, _at(0), 1), (1, _at(300), 9)]
    start = int(T0.replace(tzinfo=timezone.utc).timestamp() * 1000)
    assert rows(reads.window_fetch(windows, "key", 1, start, start + 1)) == [(start, 1)]


def test_windows_without_a_watermark_drop_nothing(spark, run_dir):
    """Newest first, a file per batch."""
    stream = _events(spark, f"{run_dir}/in", [[(1, _at(m), 1)] for m in (9000, 600, 300, 5)])
    tables = KeptTables(spark, f"{run_dir}/kept")
    live = windowed_total(stream(), "k", "ts", "1 hour")
    _finish(keep_windows(live, tables, "w", "k", f"{run_dir}/c", availableNow=True))
    assert tables.windows("w").count() == 4
    assert len([n for n in os.listdir(f"{run_dir}/c/commits") if n.isdigit()]) == 4


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_interval_join_equals_batch_up_to_the_watermark(spark, run_dir, salts):
    rng = random.Random(2)
    make = lambda n: [(rng.randrange(3), _at(rng.randrange(n * 200, n * 200 + 200)), rng.randrange(99))
                      for _ in range(12)]
    closing = [(0, _at(9000), 0)]
    sides = {}
    for side in ("l", "r"):
        batches = [make(0), make(1), make(2), closing, closing]
        sides[side] = (_events(spark, f"{run_dir}/{side}", batches), [r for b in batches for r in b])
    live = interval_left_join(sides["l"][0](), sides["r"][0](), "k", late="10 minutes", salts=salts)
    query = (
        live.select("k", "v", "right_v", "ts").writeStream.outputMode("append")
        .option("checkpointLocation", f"{run_dir}/c").format("parquet").option("path", f"{run_dir}/out")
        .trigger(availableNow=True).start()
    )
    _finish(query)
    schema = "k bigint, ts timestamp, v bigint"
    batch = interval_left_join(
        spark.createDataFrame(sides["l"][1], schema), spark.createDataFrame(sides["r"][1], schema), "k"
    ).select("k", "v", "right_v", "ts")
    before = F.col("ts") < F.lit(_at(5000))
    got = spark.read.schema("k bigint, v bigint, right_v bigint, ts timestamp").parquet(f"{run_dir}/out")
    assert rows(got.where(before)) == rows(batch.where(before))


def test_every_change_becomes_a_document(spark, log, run_dir):
    live = Ledger(log.stream(1)).item_totals(["sold"])
    documents = json_documents(live.select("item_id", "sold"))
    _finish(to_index(documents, f"{run_dir}/index", f"{run_dir}/c", fmt="text", availableNow=True))
    lines = spark.read.text(f"{run_dir}/index").count()
    assert lines > live_keys(log)


def test_changes_are_published_to_their_topics(spark, log, run_dir):
    """The rows a Kafka sink would be given, written to files instead."""
    live = Ledger(log.stream()).customer_totals()
    records = topic_records(published(live, "customer_totals", "customer_id"))
    _finish(to_index(records, f"{run_dir}/out", f"{run_dir}/c", fmt="parquet", availableNow=True))
    sent = spark.read.parquet(f"{run_dir}/out")
    got = sent.select("topic", long_from_bytes("key"), long_from_bytes("value"))
    batch = Ledger(log.batch())
    want = [
        (f"{name}-topic", *r)
        for name, total in (
            ("sale-qty-by-cust", batch.sold_by_customer()),
            ("rets-qty-by-cust", batch.returned_by_customer()),
            ("items-with-cust", batch.items_with_customer()),
        )
        for r in rows(total)
    ]
    assert rows(got) == sorted(want)


def live_keys(log):
    return len({r[0] for n in ("item", "sale") for r in log.rows[n]})
