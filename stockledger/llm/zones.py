"""Centroid clustering over zone maps: vectors in the order of a Hilbert curve, cut into blocks with min/max boxes.

Vectors that follow each other on the curve are near each other, so a block of them has a small box. How much farther one
centroid is than another, in squared distances, is linear in the vector, so its least value over the box is taken at one end of each
side. Where that bound says a centroid is farther than the one nearest the box's middle all over the box, it is nobody's nearest there. Only the rest,
the block's candidates, are compared with the vectors, exactly and a block at a time; a block with one candidate adds the sums it was stored
with. The blocks are written once and read in every round. What the driver holds is the centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.shared import written

# Vectors in a block.
BLOCK = 256

# Bits of the curve's cells in each dimension.
CURVE_BITS = 3

# Components beyond this are refused: squared distances of 64 of them would not fit a long.
LARGEST = 2**27

_BLOCKS = "ids array<bigint>, vectors binary, low binary, high binary, sums binary"


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1:") -> DataFrame:
    """Lloyd's rounds in whole numbers over ``rows`` (vec_id, embedding).

    Returns (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector kept. A vector is kept if it has exactly
    ``dims`` components, none null or non-finite; a component x counts as floor(scale * x). Centroids start as the ``k`` vectors whose
    sha256 of the seed and the id is smallest (a null id as an empty one; equal ids by their components), fewer where fewer are kept. Ties go to the
    smaller number. A row that is repeated counts as often as it is there. Nothing kept: no row. Other columns are ignored.
    Components of more than 2**27 after scaling fail the query.
    """
    whole = written(rows.select("vec_id", "embedding").mapInArrow(_whole_numbers(dims, scale), "vec_id bigint, vector binary"))
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    starts = whole.orderBy(digest, "vector").limit(k).select("vector").collect()
    centroids = np.array([np.frombuffer(r["vector"], "<i4") for r in starts], np.int64).reshape(-1, dims)
    zones = blocks(whole, dims)
    for _ in range(rounds if len(centroids) else 0):
        sums = zones.mapInArrow(_summed(centroids), "cluster int, sums array<bigint>")
        told = (
            sums.select("cluster", F.posexplode("sums").alias("at", "part"))
            .groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        )
        centroids = _moved(centroids, told.collect())  # at most k * (dims + 1) rows
    found = written(zones.mapInArrow(_assigned(centroids), "vec_id bigint, cluster int, distance bigint"))
    inertia = {
        r["cluster"]: int(r["total"])
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    about = [
        (i, inertia.get(i, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
        for i, c in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return found.join(F.broadcast(rows.sparkSession.createDataFrame(about, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def blocks(whole: DataFrame, dims: int) -> DataFrame:
    """A written table of blocks of (vec_id, vector) rows along the curve, ids and vectors in one row each.

    Equal vectors are dealt on by their id, and rows that are repeated by their place, so none of them fill a range.
    """
    spans = (
        whole.select("vector").mapInArrow(_spans(dims), "dim int, low int, high int")
        .groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()  # one row a dimension
    )
    low, high = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for r in spans:
        low[r["dim"]], high[r["dim"]] = r["low"], r["high"]
    # The curve's first bits decide most of the order, so the widest dimensions come first.
    curve = whole.withColumn("place", F.monotonically_increasing_id()).mapInArrow(
        _on_curve(low, high), "vec_id bigint, vector binary, place bigint, curve binary"
    )
    ordered = curve.repartitionByRange("curve", "vec_id", "place").sortWithinPartitions("curve", "vec_id", "place")
    return written(ordered.select("vec_id", "vector").mapInArrow(_cut(dims), _BLOCKS))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells (n x dims, values below 2**bits) along a Hilbert curve, as big-endian bytes.

    Skilling's transform (2004), a column at a time for all rows: undo the rotations from the highest bit down, then
    the Gray code across the dimensions; the place's bits are those of all dimensions, highest first.
    """
    x = cells.T.astype(np.int64).copy()
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    planes = [(x >> level) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be the nearest of some point in the box, ascending."""
    middle = np.abs(2 * centroids - (low + high))  # twice the distance from the box's middle, in each dimension
    best = centroids[(middle.astype(np.float64) ** 2).sum(1).argmin()]
    # Squared distance of each centroid less that of the best: a constant, and twice the vector times this.
    slope = best - centroids
    least = np.minimum(2 * low * slope, 2 * high * slope).sum(1)
    return np.flatnonzero((centroids * centroids).sum(1) - (best * best).sum() + least <= 0)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each vector's nearest centroid, the smaller of equals, and its squared distance."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= 2**20:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)  # whole numbers below 2**53: exact
        far = ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
    else:
        far = np.stack([((vectors - c) ** 2).sum(1) for c in centroids], axis=1)
    best = far.argmin(1)
    return best, far[np.arange(len(far)), best]


# Work inside tasks.

_Batches = Iterable[pa.RecordBatch]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims)


def _whole_numbers(dims: int, scale: int):
    def run(batches: _Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("embedding")), -1)
            sized = batch.filter(pc.equal(sizes, dims))
            flat = sized.column("embedding").flatten()
            values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
            finite = np.isfinite(values).all(1)
            whole = np.floor(scale * values[finite])
            if np.abs(whole).max(initial=0) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            ids = sized.column("vec_id").filter(pa.array(finite))
            blobs = [v.tobytes() for v in whole.astype("<i4")]
            yield pa.RecordBatch.from_arrays([ids, pa.array(blobs, pa.binary())], ["vec_id", "vector"])

    return run


def _spans(dims: int):
    def run(batches: _Batches) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims, 2**30, np.int32), np.full(dims, -(2**30), np.int32)
        for batch in batches:
            if batch.num_rows:
                vectors = _vectors(batch.column("vector"), dims)
                low, high = np.minimum(low, vectors.min(0)), np.maximum(high, vectors.max(0))
        if (low <= high).all():
            at = np.arange(dims, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (at, low, high)], ["dim", "low", "high"])

    return run


def _on_curve(low: np.ndarray, high: np.ndarray):
    width = np.maximum(high - low + 1, 1)
    order = np.argsort(-width, kind="stable")

    def run(batches: _Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vector"), len(low)).astype(np.int64)
            places = hilbert((((vectors - low) << CURVE_BITS) // width)[:, order], CURVE_BITS)
            curve = pa.array([p.tobytes() for p in places], pa.binary())
            names = ["vec_id", "vector", "place"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), curve], [*names, "curve"])

    return run


def _cut(dims: int):
    def run(batches: _Batches) -> Iterator[pa.RecordBatch]:
        ids: list = []
        vectors: list[bytes] = []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            vectors += batch.column("vector").to_pylist()
            while len(ids) >= BLOCK:
                yield _block(ids[:BLOCK], vectors[:BLOCK], dims)
                del ids[:BLOCK], vectors[:BLOCK]
        if ids:
            yield _block(ids, vectors, dims)

    return run


def _block(ids: list, vectors: list[bytes], dims: int) -> pa.RecordBatch:
    whole = np.frombuffer(b"".join(vectors), "<i4").reshape(-1, dims).astype(np.int64)
    blobs = [b"".join(vectors), *(a.astype("<i8").tobytes() for a in (whole.min(0), whole.max(0), whole.sum(0)))]
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(pa.int64())), *(pa.array([b], pa.binary()) for b in blobs)],
        ["ids", "vectors", "low", "high", "sums"],
    )


def _zones(batches: _Batches, dims: int) -> Iterator[tuple]:
    """(ids, vectors, low, high, sums) of every block."""
    for batch in batches:
        for ids, vectors, *ends in zip(*(batch.column(n) for n in ("ids", "vectors", "low", "high", "sums"))):
            whole = np.frombuffer(vectors.as_py(), "<i4").reshape(-1, dims).astype(np.int64)
            yield ids, whole, *(np.frombuffer(e.as_py(), "<i8") for e in ends)


def _summed(centroids: np.ndarray):
    """Per task and cluster one row: the sums of its vectors' components, and their number."""
    k, dims = centroids.shape

    def run(batches: _Batches) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for _, vectors, low, high, total in _zones(batches, dims):
            near = candidates(low, high, centroids)
            if len(near) == 1:
                sums[near[0], :dims] += total
                sums[near[0], dims] += len(vectors)
                continue
            best, _ = nearest(vectors, centroids[near])
            for i, number in enumerate(near):
                mine = vectors[best == i]
                sums[number, :dims] += mine.sum(0)
                sums[number, dims] += len(mine)
        some = np.flatnonzero(sums[:, dims])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"]
        )

    return run


def _moved(centroids: np.ndarray, told: list) -> np.ndarray:
    """Each centroid that has vectors at the floor of their mean."""
    dims = centroids.shape[1]
    sums = {(r["cluster"], r["at"]): int(r["total"]) for r in told}
    moved = centroids.copy()
    for number in {c for c, _ in sums}:
        moved[number] = [sums[number, i] // sums[number, dims] for i in range(dims)]
    return moved


def _assigned(centroids: np.ndarray):
    dims = centroids.shape[1]

    def run(batches: _Batches) -> Iterator[pa.RecordBatch]:
        for ids, vectors, low, high, _ in _zones(batches, dims):
            near = candidates(low, high, centroids)
            best, far = nearest(vectors, centroids[near])
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array(near[best], pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"]
            )

    return run
