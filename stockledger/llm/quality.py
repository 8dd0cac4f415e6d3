"""A quality classifier on random-indexing vectors pooled per document.

Words and the shapes of words (case, trailing signs, whether the word repeats the one before)
are rows of two small hashed tables. Each row gathers the index vectors, sparse, fixed and
random, of its neighbours over the whole corpus; partial tables are summed by Spark. A document is
the mean of its words' and of its shapes' rows. A network with one hidden layer is fitted
in numpy on a bounded sample of labelled documents, and a temperature calibrates it on rows set aside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.shared import WordHashes, as_bytes, place_bound, slices, word_hashes, written

WORD_ROWS, SHAPE_ROWS, DIMENSIONS = 2**14, 2**11, 32

# Labelled rows the network is fitted on at most, those with the smallest hashes of their ids.
TRAINING_ROWS = 20_000

# A score from which on the label 1 is predicted.
PREDICTED_FROM = 0.3

_ROWS = WORD_ROWS + SHAPE_ROWS
_BLOCK = 1024  # table rows per message
_SIGNS = re.compile(rb"[^0-9A-Za-z\x80-\xff]*$")


def index_vectors() -> np.ndarray:
    """Four entries of +1 or -1 in each row, the same in every process."""
    random = np.random.default_rng(11)
    table = np.zeros((_ROWS, DIMENSIONS), np.float32)
    for _ in range(4):
        table[np.arange(_ROWS), random.integers(0, DIMENSIONS, _ROWS)] += random.choice([-1, 1], _ROWS)
    return table


class Rows(WordHashes):
    """Word to its row of the word table and, above it, its row of the shape table."""

    def __missing__(self, word: bytes) -> int:
        stem = word[: _SIGNS.search(word).start()]
        case = "u" if len(stem) > 1 and stem.isupper() else "t" if stem[:1].isupper() else "l" if stem.isalpha() else "o"
        shape = f"{case}{min(len(stem), 12) // 4}".encode() + word[len(stem) :][:3]
        in_shapes = xxhash.xxh64_intdigest(shape) % (SHAPE_ROWS // 2)
        value = self[word] = xxhash.xxh64_intdigest(word) % WORD_ROWS + in_shapes * WORD_ROWS
        return value


def _rows_of(texts: list[bytes], cache: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows and shape rows of all words, and where documents start."""
    both, starts = word_hashes([t.split() for t in texts], cache)
    words, shapes = (both % WORD_ROWS).astype(np.int64), (both // WORD_ROWS).astype(np.int64)
    again = np.concatenate([[False], both[1:] == both[:-1]])[: len(both)]
    again[starts[:-1][starts[:-1] < len(both)]] = False
    return words, shapes + again * (SHAPE_ROWS // 2) + WORD_ROWS, starts


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, cache = index_vectors(), Rows()
    table = np.zeros((DIMENSIONS, _ROWS))
    for _, texts in slices(batches):
        words, shapes, starts = _rows_of(texts, cache)
        if not len(words):
            continue
        first, last = np.zeros(len(words), bool), np.zeros(len(words), bool)
        filled = starts[:-1][np.diff(starts) > 0]
        first[filled], last[starts[1:][np.diff(starts) > 0] - 1] = True, True
        for d in range(DIMENSIONS):
            own = index[words, d] + index[shapes, d]
            near = np.where(first, 0, np.roll(own, 1)) + np.where(last, 0, np.roll(own, -1))
            table[d] += np.bincount(words, near, _ROWS) + np.bincount(shapes, near, _ROWS)
    for block in range(_ROWS // _BLOCK):
        part = np.ascontiguousarray(table[:, block * _BLOCK : (block + 1) * _BLOCK]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part.tobytes()])], names=["block", "part"])


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros((DIMENSIONS, _BLOCK), np.int64)
    for part in group.column("part"):
        total += np.frombuffer(part.as_py(), part_type(part.as_py())).reshape(total.shape)
    return pa.table({"block": group.column("block").slice(0, 1), "part": [total.tobytes()]})


def part_type(part: bytes) -> type:
    """Tasks send 32-bit sums, sums of tasks are 64-bit."""
    return np.int32 if len(part) == DIMENSIONS * _BLOCK * 4 else np.int64


def context_table(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all rows, from every document; of fixed size whatever the corpus."""
    parts = as_bytes(docs).mapInArrow(_gathered, "block bigint, part binary")
    table = np.zeros((DIMENSIONS, _ROWS), np.float32)
    for row in parts.groupBy("block").applyInArrow(_summed, "block bigint, part binary").collect():
        at = row["block"] * _BLOCK
        table[:, at : at + _BLOCK] = np.frombuffer(row["part"], np.int64).reshape(DIMENSIONS, _BLOCK)
    return table / np.maximum(np.linalg.norm(table, axis=0), 1)


def document_vectors(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """doc_id and its vector: mean word row, mean shape row, log of the number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("vector", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, cache = shared.value, Rows()
        for part, texts in slices(batches):
            words, shapes, starts = _rows_of(texts, cache)
            counts = np.diff(starts)
            pooled = np.zeros((len(texts), 2 * DIMENSIONS + 1), np.float32)
            filled = np.flatnonzero(counts)
            if len(filled):
                for d in range(DIMENSIONS):
                    pooled[filled, d] = np.add.reduceat(vectors[d][words], starts[:-1][filled])
                    pooled[filled, DIMENSIONS + d] = np.add.reduceat(vectors[d][shapes], starts[:-1][filled])
                pooled[filled] /= counts[filled, None]
            pooled[:, -1] = np.log1p(counts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([v.tobytes() for v in pooled], pa.binary())], names=schema.names
            )

    return as_bytes(docs, "doc_id").mapInArrow(run, schema)


class Network:
    """Inputs to tanh units to one logit, divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 5):
        random = np.random.default_rng(seed)
        aside = np.arange(len(y)) % 5 == 0
        self.mean = x.mean(0) if len(x) else np.zeros(2 * DIMENSIONS + 1)
        self.scale = np.maximum(x.std(0), 1e-3) if len(x) else np.ones(2 * DIMENSIONS + 1)
        n = len(self.mean)
        self.w = [random.normal(0, n**-0.5, (n, hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.temperature, self.prior = 1.0, float((y.sum() + 1) / (len(y) + 2))
        self.fitted = len(set(y[~aside].tolist())) == 2
        if not self.fitted:
            return  # no or one class only: the score is the smoothed share of label 1
        self._fit(x[~aside], y[~aside], epochs, random)
        if aside.any():
            logits = self._logits(x[aside])
            tried = np.exp(np.linspace(-1.5, 2, 71))
            losses = [np.mean(np.logaddexp(0, -np.where(y[aside] == 1, logits, -logits) / t)) for t in tried]
            self.temperature = float(tried[int(np.argmin(losses))])

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return self._hidden((x - self.mean) / self.scale) @ self.w[2] + self.w[3]

    def _fit(self, x: np.ndarray, y: np.ndarray, epochs: int, random, rate: float = 3e-3, decay: float = 1e-4) -> None:
        x = (x - self.mean) / self.scale
        first, second, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = random.permutation(len(y))
            for at in range(0, len(y), 128):
                rows = order[at : at + 128]
                h = self._hidden(x[rows])
                error = (1 / (1 + np.exp(-(h @ self.w[2] + self.w[3]))) - y[rows]) / len(rows)
                back = np.outer(error, self.w[2]) * (1 - h * h)
                slopes = [x[rows].T @ back, back.sum(0), h.T @ error, error.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(slopes):
                    g = g + decay * self.w[i]
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-self._logits(x) / self.temperature))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float32).reshape(len(vectors), 2 * DIMENSIONS + 1).astype(np.float64)


def quality_scores(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Per row of ``docs`` doc_id, held_out, score (0 to 1) and predicted.

    Labels of held-out ids (crc32 of the id as text divisible by 5) are never read into the fit, nor are null labels.
    A null or empty text has the zero vector and a score like any other; a null id counts as not held
    out. Without labels of both classes every score is their smoothed mean. Repeated rows give repeated rows and count once in
    the fit, which takes the ``training_rows`` labelled rows of the smallest hashes. A very long text is a slice of its own.
    """
    vectors = written(document_vectors(docs, context_table(docs)))
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    place = F.xxhash64("doc_id", "vector").alias("place")
    labelled = vectors.join(known, "doc_id").select("vector", "quality", place)
    # Rows that are repeated count once, and what lies beyond the bound stays where it is.
    bound = place_bound(written(labelled.select("place").distinct()), training_rows)
    sample = (
        labelled.where(F.col("place") <= bound).groupBy("place")
        .agg(F.first("vector").alias("vector"), F.max("quality").alias("quality"))
        .orderBy("place").limit(training_rows).collect()
    )
    x = _matrix([bytes(r["vector"]) for r in sample])
    network = Network(x, np.array([1.0 if r["quality"] >= 1 else 0.0 for r in sample]))
    schema = T.StructType([vectors.schema["doc_id"], *T.StructType.fromDDL("held_out boolean, score double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = network.scores(_matrix(batch.column("vector").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=schema.names
            )

    marked = vectors.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    return marked.mapInArrow(run, schema).withColumn(
        "predicted", F.when(F.col("score") >= PREDICTED_FROM, 1).otherwise(0)
    )
