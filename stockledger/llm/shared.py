"""Helpers of the text operators: word hashes in batches, written tables, size-checked joins."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes worked on at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 2 * 1024 * 1024

# Spark's bound on the bytes of a batch for Python.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Distinct words a task remembers the hashes of before it starts over.
CACHED_WORDS = 300_000

# Rows of plain longs a semi join may broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one under the warehouse, with a warning, only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        warnings.warn("spark.checkpoint.dir is not set: tables go to the warehouse, which all executors must share", stacklevel=2)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/llm-work"


def written(df: DataFrame) -> DataFrame:
    """The rows written as a table in the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand Python batches of some ``SLICE_BYTES``, not of up to 64 MB, which JVM and Python hold several times over.

    At the end the session has the bound it had.
    """
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, SLICE_BYTES)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def written_in_slices(df: DataFrame) -> DataFrame:
    """:func:`written` for rows with texts that go through Python; see :func:`small_batches`."""
    with small_batches(df.sparkSession):
        return written(df)


def semi(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key is in ``ids`` (a written table of one long column).

    Few ids are broadcast, so that wide rows stay where they are; the answer is the same
    either way.
    """
    few = ids.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(ids) if few else ids, key, "left_semi")


def without(rows: DataFrame, gone: DataFrame, *keys: str) -> DataFrame:
    """``rows`` whose keys (null as a value) are not in ``gone``, a written table of a few longs; see :func:`semi`."""
    few = gone.count() <= BROADCAST_ROWS
    named = gone.select(*[F.col(k).alias(f"gone_{k}") for k in keys])
    same = [rows[k].eqNullSafe(named[f"gone_{k}"]) for k in keys]
    return rows.join(F.broadcast(named) if few else named, same, "left_anti")


def place_bound(places: DataFrame, n: int) -> int:
    """A bound at or below which lie the ``n`` smallest of distinct longs, and no more than ``n`` others, by exact counts.

    All of them, if there are no more than ``n``. Each round divides the interval the bound is in by 4096 and counts; the driver hears
    a number a part.
    """
    low, bits, before = -(2**63), 64, 0
    while True:
        inside, bits = places.where(F.col("place").between(low, low + 2**bits - 1)), max(bits - 12, 0)
        part = F.shiftright(F.col("place"), bits).alias("part")
        counts = {r["part"]: r["n"] for r in inside.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
        for k in sorted(counts):
            if before + counts[k] >= n:
                break
            before += counts[k]
        else:
            return 2**63 - 1
        if counts[k] <= n or bits == 0:
            return ((k + 1) << bits) - 1
        low = k << bits


def as_bytes(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and the text as UTF-8 bytes, null texts empty."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select(*columns, text)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches so that the texts of a slice hold some ``SLICE_BYTES`` together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column("text")
        lengths = np.fromiter((len(v.as_buffer()) for v in sizes), np.int64, batch.num_rows)
        group = np.cumsum(lengths) // SLICE_BYTES
        starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            part = batch.slice(a, b - a)
            yield part, part.column("text").to_pylist()


class WordHashes(dict):
    """Word to 64-bit hash, each distinct word hashed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def trim(self) -> None:
        if len(self) > CACHED_WORDS:
            self.clear()


def word_hashes(split: list[list[bytes]], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes in one array, and where each document starts in it (one more at the end)."""
    starts = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(words) for words in split], out=starts[1:])
    flat = chain.from_iterable(split)
    hashes = np.fromiter(map(cache.__getitem__, flat), np.uint64, int(starts[-1]))
    cache.trim()
    return hashes, starts


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WEIGHTS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def shingles(hashes: np.ndarray, starts: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per document the hashes of its windows of ``width`` words; of all its words if there are fewer."""
    n = len(hashes)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled += mixed(hashes[k : n - width + 1 + k] + np.uint64(k)) * np.uint64(_WEIGHTS[k % 5] + 2 * (k // 5))
    rolled = mixed(rolled)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= width:
            out.append(rolled[a : b - width + 1])
        elif b > a:
            whole = xxhash.xxh64_intdigest(hashes[a:b].tobytes(), seed=b - a)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(rolled[:0])
    return out
