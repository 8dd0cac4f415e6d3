"""Benchmark decontamination by greedy string tiling.

Documents and test items meet by a join on seeds, windows of a few words. The items' seeds are a table; a filter of bounded
size built from them lets a document name the seeds that may be in it, and only documents with enough of them go
on. Pairs whose shared seeds could cover enough of the item are tiled in tasks: the longest common run of words
outside earlier tiles is found with Karp-Rabin hashes, marked in both, and so on down to
the length of a seed. Tiles may come in any order, so reordered passages still count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.shared import WordHashes, as_bytes, mixed, shingles, slices, without, word_hashes, written, written_in_slices

# Words of a seed, which is also the shortest tile.
SEED = 5

# Share of an item's words in tiles from which on a document is contaminated.
MIN_COVERAGE = 0.5

# Bits of the filter of the items' seeds for each seed, and at most in all (32 MB): with more seeds it lets more
# documents through to the join, which is exact.
SEED_BITS, FILTER_BITS = 32, 2**28

# Bytes of the filter in one row while it is put together.
CHUNK = 2**16

# Items that one document is tiled with at once.
HEAP = 500

# Words are compared in lower case and without ASCII punctuation.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)

_BASE = 0x9E3779B97F4A7C15


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Runs:
    """Karp-Rabin hashes of the windows of a word sequence that touch no marked word."""

    def __init__(self, words: np.ndarray):
        self.words, self.marked = words, np.zeros(len(words), bool)
        self.powers = np.full(len(words) + 1, _BASE, np.uint64)
        self.powers[0] = 1
        self.powers = np.cumprod(self.powers, dtype=np.uint64)
        # sums[i] of the words before i, each times a falling power: windows differ by one product.
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(words) * self.powers[:-1], dtype=np.uint64)])

    def windows(self, length: int, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the free windows; ``powers`` of the longer sequence level the hashes."""
        taken = np.concatenate([[0], np.cumsum(self.marked)])
        starts = np.flatnonzero(taken[length:] == taken[:-length])
        sums = self.sums[starts + length] - self.sums[starts]
        return starts, sums * powers[len(powers) - 1 - starts]

    def mark(self, start: int, length: int) -> None:
        self.marked[start : start + length] = True

    def is_free(self, start: int, length: int) -> bool:
        return not self.marked[start : start + length].any()


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = SEED, gaps: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs (start in item, start in text, length), longest first.

    Equal lengths go by the start in the item, then in the text. ``gaps`` marks words of the text
    that no tile may use.
    """
    a, b = Runs(item), Runs(text)
    if gaps is not None:
        b.marked |= gaps
    powers = a.powers if len(a.powers) >= len(b.powers) else b.powers

    def alike(length: int) -> bool:
        return np.intersect1d(a.windows(length, powers)[1], b.windows(length, powers)[1]).size > 0

    found, longest = [], min(len(item), len(text))
    while longest >= shortest:
        low, high = shortest - 1, longest  # a common run of a length holds all shorter ones
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if alike(middle) else (low, middle - 1)
        if low < shortest:
            break
        at_a, hash_a = a.windows(low, powers)
        at_b, hash_b = b.windows(low, powers)
        here = np.isin(hash_b, hash_a)
        order = np.argsort(hash_b[here], kind="stable")
        at_b, hash_b = at_b[here][order], hash_b[here][order]
        # Places of each hash in the text; those that are taken stay so and are passed over for good.
        least, end = np.searchsorted(hash_b, hash_a), np.searchsorted(hash_b, hash_a, side="right")
        passed: dict[int, int] = {}
        for i, at, stop in zip(at_a.tolist(), least.tolist(), end.tolist()):
            if at == stop or not a.is_free(i, low):
                continue
            j = passed.get(at, at)
            while j < stop and not b.is_free(int(at_b[j]), low):
                j += 1
            passed[at] = j
            if j < stop and np.array_equal(item[i : i + low], text[at_b[j] : at_b[j] + low]):
                a.mark(i, low)
                b.mark(int(at_b[j]), low)
                found.append((i, int(at_b[j]), low))
        longest = low - 1 if not found or found[-1][2] != low else low
    return found


def covered(item: np.ndarray, words: np.ndarray, least: float) -> tuple[int, int] | None:
    """(tiles, words in tiles) if they are the share ``least`` of the item."""
    of_item, of_text = (shingles(w, np.array([0, len(w)]), SEED)[0] for w in (item, words))
    held = np.isin(of_item, of_text)
    if _reach(held, len(item)).sum() < least * len(item):
        return None  # tiles are made of shared seeds only
    found = tiles(item, words, SEED, ~_reach(np.isin(of_text, of_item), len(words)))
    n = sum(length for _, _, length in found)
    return (len(found), n) if n >= least * len(item) else None


def _reach(seeds: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words are in one of the marked seeds."""
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(seeds)
    edges[at] += 1
    np.subtract.at(edges, at + SEED, 1)
    return np.cumsum(edges)[:n] > 0


# The items.

_KNOWN = "item bigint, words binary, size int"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the items that have a seed."""
    cache = WordHashes()
    for part, texts in slices(batches):
        hashes, starts = word_hashes([plain_words(t) for t in texts], cache)
        own = [hashes[a:b] for a, b in zip(starts[:-1], starts[1:])]
        long = [i for i, words in enumerate(own) if len(words) >= SEED]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("item").take(pa.array(long, pa.int64())),
                pa.array([own[i].tobytes() for i in long], pa.binary()),
                pa.array([len(own[i]) for i in long], pa.int32()),
            ],
            names=["item", "words", "size"],
        )


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct seeds of each item and how often it has them."""
    for batch in batches:
        for item, words, size in zip(*(batch.column(c).to_pylist() for c in ("item", "words", "size"))):
            seeds, times = np.unique(shingles(np.frombuffer(words, np.uint64), np.array([0, size]), SEED)[0], return_counts=True)
            n = len(seeds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seeds.view(np.int64)), pa.array([item] * n, pa.int64()), pa.array(times, pa.int32()), pa.array([size] * n, pa.int32())],
                names=["seed", "item", "times", "size"],
            )


class SeedFilter:
    """A Bloom filter of two probes over a power of two of bits."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.bytes = np.zeros(max(bits // 8, 1), np.uint8)

    def _probes(self, seeds: np.ndarray) -> Iterator[np.ndarray]:
        yield seeds >> self.shift
        yield (seeds * np.uint64(_BASE)) >> self.shift

    def add(self, seeds: np.ndarray) -> None:
        for at in self._probes(seeds):
            np.bitwise_or.at(self.bytes, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, seeds: np.ndarray) -> np.ndarray:
        out = np.ones(len(seeds), bool)
        for at in self._probes(seeds):
            out &= (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def seed_filter(seeds: DataFrame) -> SeedFilter:
    """The filter of a table of seeds, put together in chunks by tasks; the driver gets no more than its bytes."""
    wanted = SEED_BITS * max(seeds.select("seed").distinct().count(), 1)
    bits = min(max(1 << (wanted - 1).bit_length(), 64), FILTER_BITS)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SeedFilter(bits)
        for batch in batches:
            own.add(batch.column("seed").to_numpy().view(np.uint64))
        for at in range(0, len(own.bytes), CHUNK):
            piece = own.bytes[at : at + CHUNK]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([piece.tobytes()], pa.binary())], names=["at", "bits"])

    def joined(table: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]
        whole = np.bitwise_or.reduce(pieces).tobytes()
        return pa.table({"at": table.column("at")[:1], "bits": pa.array([whole], pa.binary())})

    chunks = "at bigint, bits binary"
    out = SeedFilter(bits)
    for row in seeds.select("seed").mapInArrow(part, chunks).groupBy("at").applyInArrow(joined, chunks).collect():
        out.bytes[row["at"] : row["at"] + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return out


# Documents and items.


def _tiled(docs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """Rows of :func:`contaminated`, written, with the text_key of the document."""
    numbered = written(as_bytes(items, "item_id").withColumn("item", F.monotonically_increasing_id()))
    known = written_in_slices(numbered.mapInArrow(_items, _KNOWN))
    seeds = written(known.mapInArrow(_item_seeds, "seed bigint, item bigint, times int, size int"))
    shortest = known.agg(F.min("size")).first()[0]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(seed_filter(seeds).__dict__)  # FILTER_BITS at most
    enough = least * (shortest or 0)
    fields = [docs.schema["doc_id"], *T.StructType.fromDDL("text binary, seeds array<bigint>").fields]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, known_seeds = WordHashes(), SeedFilter(64)
        known_seeds.__dict__.update(shared.value)
        for part, texts in slices(batches):
            hashes, starts = word_hashes([plain_words(t) for t in texts], cache)
            own = shingles(hashes, starts, SEED)
            hits = known_seeds.has(np.concatenate(own)) if own else np.zeros(0, bool)
            ends = np.cumsum([len(x) for x in own])
            rows, named = [], []
            for doc in sorted(set(np.searchsorted(ends, np.flatnonzero(hits), side="right").tolist())):
                n, mine = int(starts[doc + 1] - starts[doc]), hits[ends[doc] - len(own[doc]) : ends[doc]]
                if n >= SEED and _reach(mine, n).sum() >= enough:
                    rows.append(doc)
                    named.append(np.unique(own[doc][mine]).view(np.int64))
            if rows:
                part = part.take(pa.array(rows))
                lists = pa.array(named, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), lists], names=["doc_id", "text", "seeds"])

    held = written_in_slices(
        as_bytes(docs, "doc_id").mapInArrow(near, T.StructType(fields)).withColumn("row", F.monotonically_increasing_id())
    )
    met = written(
        held.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
        .groupBy("row", "item").agg(F.sum("times").alias("n"), F.max("size").alias("size"))
        .where(SEED * F.col("n") >= least * F.col("size")).select("row", "item")
    )
    heaps = met.groupBy("row").agg(F.ceil(F.count(F.lit(1)) / HEAP).alias("heaps"))
    asked = (
        met.join(heaps, "row").join(known, "item").join(numbered.select("item", "item_id"), "item")
        .groupBy("row", F.pmod(F.xxhash64("item"), F.col("heaps")).alias("heap"))
        .agg(F.collect_list(F.struct("item_id", "words")).alias("asked"))
    )
    out = T.StructType([docs.schema["doc_id"], items.schema["item_id"], *T.StructType.fromDDL(
        "n_tiles bigint, tiled_words bigint, item_words bigint, coverage double, text_key bigint").fields])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for part, texts in slices(batches):
            hashes, starts = word_hashes([plain_words(t) for t in texts], cache)
            rows, of, columns = [], [], []
            for doc, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
                for i, words in enumerate(part.column("asked")[doc].values.field("words").to_pylist()):
                    item = np.frombuffer(words, np.uint64)
                    if found := covered(item, hashes[a:b], least):
                        rows.append(doc)
                        of.append(part.column("asked")[doc].values.field("item_id")[i])
                        columns.append((*found, len(item), found[1] / len(item)))
            if rows:
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(at), pa.array(of, part.column("asked").type.value_type.field("item_id").type),
                        *(pa.array(c) for c in zip(*columns)), part.column("text_key").take(at),
                    ],
                    names=out.names,
                )

    texts = held.select("row", "doc_id", "text", F.xxhash64("text").alias("text_key"))
    return written_in_slices(texts.join(asked, "row").drop("row", "heap").mapInArrow(tile, out))


def contaminated(docs: DataFrame, items: DataFrame, least: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_tiles, tiled_words, item_words, coverage) of documents that hold an item.

    A document holds an item if tiles of at least ``SEED`` words cover the share ``least`` of the
    item's words. Null and empty texts hold nothing and are held by nothing, and so are items
    of fewer than ``SEED`` words. Repeated documents or items give repeated rows. Other
    columns do not matter. A very long text is a slice of its own, and the work on it grows with its length, also where one word is
    all it repeats.
    """
    return _tiled(docs, items, least).drop("text_key")


def decontaminated(docs: DataFrame, items: DataFrame, least: float = MIN_COVERAGE) -> DataFrame:
    """``docs``, all its columns, without the documents that hold an item; see :func:`contaminated`."""
    gone = written(_tiled(docs, items, least).select("doc_id", "text_key").distinct())
    row = F.struct(*docs.columns).alias("_row")
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_key")
    left = without(docs.select(row, "doc_id", key), gone, "doc_id", "text_key")
    return left.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
