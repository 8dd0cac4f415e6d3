"""How far the sources of a language differ in their words: every two sources, and every source from its language.

Terms of a language are numbered and the numbers cut into segments; the counts of a group (a source, or the language as a whole) in
a segment are the leaves of a segment tree. Trees of one segment are built together, level by level, and hash-consed: equal
pairs of children are one node, whichever group and place they belong to, so the long runs of zeros and ones of rare
terms are a few nodes. Two trees are walked at once from their roots; equal pairs of nodes are met once, with the number of times
they occur, so each pair of counts is priced once for two groups. Segments are Spark groups, and the prices of
segments are summed by Spark, which is the top of the trees.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.shared import BROADCAST_ROWS, as_bytes, slices, written

# Shares are whole numbers of this part.
PARTS = 1_000_000_000

# Leaves of all trees of one segment.
CELLS = 2**17

# Distinct (group, term) pairs a task counts before it hands them on, and bytes of a text cut up at once.
COUNTED = 300_000
PIECE = 4 * 1024 * 1024

# ASCII letters to lower case, all other ASCII characters to spaces, the rest as it is.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group, a (lang, source) pair that occurs.

    Terms are runs of letters and of characters beyond ASCII, ASCII in lower case; a language keeps those in ``min_docs`` of its documents.
    A group's share of a kept term is p = 1 + floor(1e9 * (count + 1) / (N + V)) for V kept terms and N their occurrences in
    the group. Part ``pair``: item is another source of the language with shares q, value the sum of floor((p - q)**2 / q)
    over the kept terms, 0 without any. Part ``term``: item is a kept term of the group with p > q, q the language's share; the ``top`` largest values.
    Ranks go from 1 by value, then item. Exact throughout. Null text, lang and source are empty ones; rows count as
    often as they are there; no row gives no row. Other columns are ignored. A long text is counted in pieces, so what is
    held of it besides the text is its distinct terms.
    """
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], "text")
    parts = as_bytes(named, "lang", "source").mapInArrow(
        _counted, "lang string, source string, term string, n bigint, docs bigint"
    )
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    kept = written(
        counts.withColumn("docs", F.sum("docs").over(term))
        .withColumn("is_first", (F.col("source") == F.min("source").over(term)) & F.col("term").isNotNull())
        .where(F.col("term").isNull() | (F.col("docs") >= min_docs))
        .drop("docs")
    )
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = (
        kept.groupBy("lang")
        .agg(F.sum(F.col("is_first").cast("bigint")).alias("v"), F.count_if(F.col("term").isNull()).alias("groups"))
        .withColumn("segments", F.greatest(F.lit(1), F.ceil(F.col("v") * (F.col("groups") + 1) / CELLS)).cast("bigint"))
        .drop("groups")
    )
    langs = written(langs)
    langs = F.broadcast(langs) if langs.count() <= BROADCAST_ROWS else langs
    rows = kept.where("term IS NOT NULL").join(langs, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "segments").alias("segment"), "source", "term", "n", "v"
    )
    marks = groups.join(langs, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("segments") - 1)).alias("segment"),
        "source", F.lit(None).cast("string").alias("term"), "n", "v",
    )
    priced = written(
        rows.unionByName(marks).groupBy("lang", "segment")
        .applyInArrow(_priced(top), "lang string, source string, part string, item string, value bigint")
    )
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, priced.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", "rank"
    )


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a piece at a time; no term is cut."""
    plain, at = text.translate(_TERMS), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term of a group, and one row without a term for the group itself."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    seen, held = set(), 0
    for batch, texts in slices(batches):
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            group = lang, source
            if group not in counts:
                counts[group] = Counter(), Counter()
            n, documents = counts[group]
            before, distinct = len(n), set()
            for words in terms(text):
                n.update(words)
                distinct.update(words)
            documents.update(distinct)
            held += len(n) - before
            if held > COUNTED:
                yield _rows(counts, seen)
                counts, held = {}, 0
    yield _rows(counts, seen)


def _rows(counts: dict, seen: set) -> pa.RecordBatch:
    langs, sources, words, ns, documents = [], [], [], [], []
    for (lang, source), (n, of) in counts.items():
        mark = [] if (lang, source) in seen else [None]
        seen.add((lang, source))
        size = len(n) + len(mark)
        langs += [lang] * size
        sources += [source] * size
        words += [*n, *mark]
        ns += [*n.values(), *([0] * len(mark))]
        documents += [*map(of.__getitem__, n), *([0] * len(mark))]
    columns = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(words, pa.binary()).cast(pa.string())]
    columns += [pa.array(ns, pa.int64()), pa.array(documents, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


# Trees of one segment.


class Trees:
    """Segment trees over the rows of ``leaves`` (one group each, equal widths), node 0 standing for no leaf.

    ``leaves`` of every group are padded to a power of two, ``roots`` its root, ``children`` what the nodes of each level are made of.
    """

    def __init__(self, leaves: np.ndarray):
        width = 1 << max(leaves.shape[1] - 1, 0).bit_length()
        level = np.zeros((len(leaves), width), np.int64)
        level[:, : leaves.shape[1]] = leaves
        self.leaves, self.children = level, []
        while level.shape[1] > 1:
            left, right = level[:, 0::2], level[:, 1::2]
            span = int(level.max(initial=0)) + 1
            nodes, level = np.unique(np.append(left * span + right, 0), return_inverse=True)
            level = level[:-1].reshape(left.shape)
            self.children.append(np.divmod(nodes, span))
        self.roots = level[:, 0]

    def met(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of leaves of groups a and b, each once, and how often they occur; every pair of nodes is opened once."""
        one, other, times = self.roots[a : a + 1], self.roots[b : b + 1], np.ones(1, np.int64)
        for left, right in reversed(self.children):
            one = np.concatenate([left[one], right[one]])
            other = np.concatenate([left[other], right[other]])
            span = int(other.max()) + 1
            pairs, at = np.unique(one * span + other, return_inverse=True)
            times = np.bincount(at, np.concatenate([times, times])).astype(np.int64)
            one, other = np.divmod(pairs, span)
        real = one > 0
        return one[real], other[real], times[real]


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """p of counts in a group: in Python's whole numbers where longs would not do."""
    wide = counts.astype(object) if counts.max(initial=0) >= 2**63 // PARTS - 1 else counts
    return (1 + PARTS * (wide + 1) // (total + terms)).astype(np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _priced(top: int):
    def run(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        v = table.column("v")[0].as_py()
        marks, rows = table.filter(table.column("term").is_null()), table.filter(table.column("term").is_valid())
        totals = dict(sorted(zip(marks.column("source").to_pylist(), marks.column("n").to_pylist())))
        sources = list(totals)
        number = {s: i for i, s in enumerate(sources)}
        out: list[tuple[str, str, str, int]] = []
        if not rows.num_rows:
            out += [(a, "pair", b, 0) for a in sources for b in sources if a != b]
            return _result(lang, out)

        words, at = np.unique(np.array(rows.column("term").cast(pa.binary()).to_pylist(), object), return_inverse=True)
        counts = np.zeros((len(sources) + 1, len(words)), np.int64)
        of = np.array([number[s] for s in rows.column("source").to_pylist()])
        counts[of, at] = rows.column("n").to_numpy()
        counts[-1] = counts[:-1].sum(0)
        order = np.lexsort((np.arange(len(words)), -counts[-1]))  # terms of like counts beside each other
        words, counts = words[order], counts[:, order]
        sizes, leaves = np.unique(counts, return_inverse=True)
        trees = Trees(leaves.reshape(counts.shape) + 1)
        every = [*totals.values(), sum(totals.values())]
        share = np.stack([shares(sizes, total, v) for total in every])

        for a in range(len(sources)):
            for b in range(a):
                one, other, times = trees.met(a, b)
                p, q = share[a][one - 1], share[b][other - 1]
                out.append((sources[a], "pair", sources[b], int((times * price(p, q)).sum())))
                out.append((sources[b], "pair", sources[a], int((times * price(q, p)).sum())))
            mine, values = _above(trees, share, a, counts[a] > 0)
            best = sorted(zip((-values).tolist(), words[mine].tolist()))[:top]
            out += [(sources[a], "term", w.decode(), -value) for value, w in best]
        return _result(lang, out)

    return run


def _above(trees: Trees, share: np.ndarray, a: int, has: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the terms that group ``a`` has, and more of than the last group, with their prices."""
    last = len(trees.roots) - 1
    one, other, _ = trees.met(a, last)
    p, q = share[a][one - 1], share[last][other - 1]
    span = int(other.max()) + 1
    mine, whole = trees.leaves[a][: len(has)], trees.leaves[last][: len(has)]
    at = np.searchsorted(one * span + other, mine * span + whole)  # pairs come in order
    places = np.flatnonzero(has & (p > q)[at])
    return places, price(p, q)[at][places]


def _result(lang: str, out: list[tuple[str, str, str, int]]) -> pa.Table:
    columns = list(zip(*out)) if out else [[], [], [], []]
    names = ["source", "part", "item"]
    return pa.table(
        {"lang": pa.array([lang] * len(out), pa.string())}
        | {n: pa.array(c, pa.string()) for n, c in zip(names, columns)}
        | {"value": pa.array(columns[3], pa.int64())}
    )
