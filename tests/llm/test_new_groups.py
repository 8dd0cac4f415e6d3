"""Exact copies, centroid clusters, source divergence: against brute force and their SQL twins."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stockledger.llm import audit, exact, queries, zones
from tests import oracle
from tests.llm import brute


@pytest.mark.parametrize("name", ["op11_segment_trees", "op12_zone_maps", "op13_extendible_hash"])
def test_equals_sql(spark, data, name):
    con = oracle.connect(data)
    assert oracle.differences(queries.QUERIES[name](spark, data), con, queries.ORACLES[name]) == ""


# Exact copies.


def copies(docs):
    """Sorted (doc_id, keep_id, group_size, kept rows of the group's copies with this id, digest)."""
    groups = defaultdict(list)
    for d, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, stays = (min(known) if known else None), [True]
        for d in ids:
            first = d == keep and bool(stays)
            out.append((d, keep, len(ids), first, brute.sha(text)))
            if first:
                stays.pop()
    return Counter(out)


def found_copies(framed, rows, **more):
    df = exact.exact_duplicates(framed(rows), **more).drop("chain")
    return Counter(tuple(r) for r in df.collect())


def many(awkward, documents):
    return [*documents[:60], *awkward, *[(7000 + i, "the same text") for i in range(150)], (6999, "the\n same \t text"), (1, " "), (2, "\x0b")]


def test_exact_copies_equal_brute_force(framed, awkward, documents):
    rows = many(awkward, documents)
    assert found_copies(framed, rows) == copies(rows)


@pytest.mark.parametrize("capacity", [1, 400, 100_000])
def test_colliding_keys_are_chained_and_buckets_split(framed, awkward, documents, capacity):
    """Keys that many texts share, all in the lowest bits, and buckets of every size."""
    rows = many(awkward, documents)
    weak = lambda text: F.octet_length(text).cast("bigint") % 7
    assert found_copies(framed, rows, key_of=weak, capacity=capacity) == copies(rows)
    assert found_copies(framed, rows, capacity=capacity) == copies(rows)
    longest = exact.exact_duplicates(framed(rows), key_of=weak, capacity=capacity).agg(F.max("chain")).first()[0]
    assert longest > 3


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"), F.lit(10).cast("bigint").alias("bytes"))
    slots, depth = exact.directory(keys, 500)
    got = slots.collect()
    assert sorted(r.slot for r in got) == list(range(2**depth))
    filled = Counter()
    of = {r.slot: (r.bucket, r.depth) for r in got}
    for r in keys.collect():
        bucket, own = of[(r.key % 2**64) >> (64 - depth)]
        assert bucket == (r.key % 2**64) >> (64 - own) << (depth - own)
        filled[bucket] += 10
    assert max(filled.values()) <= 500 and len(filled) > 80 and len({d for _, d in of.values()}) > 1


def test_exact_copies_of_nothing(framed):
    assert exact.exact_duplicates(framed([])).count() == 0
    assert exact.firsts(framed([])).count() == 0


def test_rows_that_stay(framed, awkward, documents):
    rows = many(awkward, documents)
    frame = framed(rows).withColumns({"text_sha256": F.lit("x"), "row": F.lit(1), "chain": F.lit(2)})
    left = exact.firsts(frame)
    assert left.columns == frame.columns
    want = Counter((d, t) for (d, _, _, kept, t) in copies(rows).elements() if kept)
    got = Counter((r.doc_id, brute.sha(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""))) for r in left.collect())
    assert {k: v for k, v in got.items() if k[0] is not None} == {k: v for k, v in want.items() if k[0] is not None}
    assert {t for _, t in got} == {t for _, _, _, _, t in copies(rows)}


# Clusters.


def clusters(rows, k=16, rounds=3, dims=64, scale=64):
    vectors = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(vectors, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in vectors:
            of[near(v)[1]].append(v)
        for i, members in of.items():
            centroids[i] = [sum(x) // len(members) for x in zip(*members)]
    got = [(i, *near(v)[::-1]) for i, v in vectors]
    each = Counter()
    for _, c, d in got:
        each[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, c, d, each[c], sum(each.values()), digest[c]) for i, c, d in got)


def embeddings(spark, rows):
    schema = "vec_id bigint, embedding array<float>, cluster int, distance bigint, curve string"
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema).repartition(3)


def test_clusters_equal_brute_force(spark, data):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    one = given[0][1]
    awkward = [(9001, None), (9002, []), (9003, one[:63]), (9004, [*one[:63], None]), (9005, [*one[:63], float("nan")])]
    awkward += [(9006, [*one[:63], float("inf")]), (None, one), (9007, one), (9007, one), (9008, [0.0] * 64), (9008, [-5.0] * 64)]
    awkward += [(9100 + i, given[5][1]) for i in range(len(given) // 2)] + [(9099, [1000.0 * (-1) ** i for i in range(64)])]
    rows = given + awkward
    assert Counter(tuple(r) for r in zones.cluster(embeddings(spark, rows)).collect()) == clusters(rows)
    few = rows[:5] + awkward[6:9]
    assert Counter(tuple(r) for r in zones.cluster(embeddings(spark, few)).collect()) == clusters(few)


def test_large_components_are_exact_or_refused(spark):
    rows = [(i, [float((i * 37 + j) % 11 - 5) * 300_000 for j in range(64)]) for i in range(60)]
    assert Counter(tuple(r) for r in zones.cluster(embeddings(spark, rows)).collect()) == clusters(rows)
    with pytest.raises(PySparkException, match="beyond"):
        zones.cluster(embeddings(spark, [(1, [1e30] * 64)])).collect()


def test_no_vectors_no_clusters(spark):
    assert zones.cluster(embeddings(spark, [])).count() == 0
    assert zones.cluster(embeddings(spark, [(1, None), (2, [1.0])])).count() == 0


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2)])
def test_the_curve_goes_through_every_cell_to_a_neighbour(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    places = [int.from_bytes(p.tobytes(), "big") for p in zones.hilbert(cells, bits)]
    assert len(set(places)) == len(cells)
    walked = cells[np.argsort(places)]
    assert (np.abs(np.diff(walked, axis=0)).sum(1) == 1).all()


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(3)
    for _ in range(200):
        vectors, centroids = rng.integers(-40, 40, (20, 6)), rng.integers(-60, 60, (12, 6))
        near = zones.candidates(vectors.min(0), vectors.max(0), centroids)
        assert (near[zones.nearest(vectors, centroids[near])[0]] == zones.nearest(vectors, centroids)[0]).all()


def test_blocks_hold_every_vector_once(spark, data):
    whole = spark.read.parquet(f"{data}/embeddings.parquet")
    vectors = whole.select("vec_id", "embedding").mapInArrow(zones._whole_numbers(64, 64), "vec_id bigint, vector binary")
    got = zones.blocks(vectors, 64).collect()
    assert Counter(i for r in got for i in r.ids) == Counter(r.vec_id for r in vectors.collect())
    assert max(len(r.ids) for r in got) <= zones.BLOCK


def test_boxes_spare_comparisons_where_vectors_cluster(spark):
    """Vectors around twelve places: half of the blocks and more have one candidate, blocks in the order of the table have all."""
    rng = np.random.default_rng(8)
    places = rng.normal(0, 1, (12, 64))
    rows = [(i, (places[i % 12] + rng.normal(0, 0.05, 64)).tolist()) for i in range(12_000)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    vectors = frame.mapInArrow(zones._whole_numbers(64, 64), "vec_id bigint, vector binary")
    centroids = np.floor(64 * places).astype(np.int64)

    def left(blobs):
        whole = [np.frombuffer(b"".join(v), "<i4").reshape(-1, 64).astype(np.int64) for v in blobs]
        return [len(zones.candidates(w.min(0), w.max(0), centroids)) for w in whole]

    along = left([[r.vectors] for r in zones.blocks(vectors, 64).collect()])
    table = [bytes(r.vector) for r in vectors.collect()]
    across = left([table[i : i + zones.BLOCK] for i in range(0, len(table), zones.BLOCK)])
    assert np.median(along) == 1 and np.mean(along) < np.mean(across) / 2


# Divergence.


def divergence(rows, min_docs=3, top=200):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(brute._LOWER))) for t, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in docs}:
        df = Counter(w for x, _, ws in docs if x == lang for w in set(ws))
        terms = {w for w, n in df.items() if n >= min_docs}
        groups = {s: Counter() for x, s, _ in docs if x == lang}
        for x, s, ws in docs:
            if x == lang:
                groups[s].update(w for w in ws if w in terms)
        whole = sum(groups.values(), Counter())

        def share(counts, w):
            return 1 + 10**9 * (counts[w] + 1) // (sum(counts.values()) + len(terms))

        for s, mine in groups.items():
            pairs = []
            for o, other in groups.items():
                if o != s:
                    value = sum((share(mine, w) - share(other, w)) ** 2 // share(other, w) for w in terms)
                    pairs.append((-value, o.encode(), o))
            own = [(share(mine, w), share(whole, w), w) for w in terms if mine[w] > 0]
            words = [(-((p - q) ** 2 // q), w.encode(), w) for p, q, w in own if p > q]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return Counter(out)


def corpus(spark, rows):
    schema = "doc_id bigint, text string, lang string, source string, term string, n int, v int, segment int, rank int"
    return spark.createDataFrame([(i, *r, "x", 1, 2, 3, 4) for i, r in enumerate(rows)], schema).repartition(3)


AWKWARD = [
    (None, "en", "a"), ("", None, None), ("123 !?", "xx", "b"), ("only here", "yy", "c"), ("Ünï ünï Ü x A_b", None, "a"),
    ("\u0000A\u0000a", None, "b"), ("a " * 5000, None, "a"), ("a x", None, ""), ("Z z[z] `z`", "en", None), ("日本 日本", "en", "a"),
    ("日本", "en", "b"), ("日本 z", "en", "c"), ("z " * 30_000, "en", "d"), ("same words here", "de", "s"), ("same words here", "de", "s"),
    ("same words here", "de", "s"), ("same words here", "de", "t"),
]


@pytest.mark.parametrize("cells", [8, 2**17])
def test_divergence_equals_brute_force(spark, data, monkeypatch, cells):
    monkeypatch.setattr(audit, "CELLS", cells)
    given = spark.read.parquet(f"{data}/documents.parquet").select("text", "lang", "source").limit(25).collect()
    rows = [*AWKWARD, *map(tuple, given)]
    got = Counter(tuple(r) for r in audit.source_divergence(corpus(spark, rows)).collect())
    assert got == divergence(rows)


def test_counting_in_pieces_and_flushes_changes_nothing(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(audit, "PIECE", 7)
    monkeypatch.setattr(audit, "COUNTED", 2)
    texts = [(t or "").encode() for t, _, _ in AWKWARD]
    batch = pa.RecordBatch.from_pydict({"lang": ["l"] * len(texts), "source": ["s"] * len(texts), "text": texts})
    counts, docs, marks = Counter(), Counter(), 0
    for part in audit._counted([batch]):
        for r in part.to_pylist():
            if r["term"] is None:
                marks += 1
            else:
                counts[r["term"]] += r["n"]
                docs[r["term"]] += r["docs"]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.decode().translate(brute._LOWER)) for t in texts]
    assert counts == Counter(w for ws in words for w in ws) and docs == Counter(w for ws in words for w in set(ws))
    assert marks == 1


def test_no_documents_no_divergence(spark):
    assert audit.source_divergence(corpus(spark, [])).count() == 0


def test_equal_subtrees_are_one_node_and_met_once():
    leaves = np.ones((2, 1024), np.int64)
    leaves[1, 5] = 2
    trees = audit.Trees(leaves)
    assert sum(len(left) - 1 for left, _ in trees.children) <= 2 * 10  # one node a level, and those on the way to the odd leaf
    one, other, times = trees.met(0, 1)
    assert list(zip(one, other, times)) == [(1, 1, 1023), (1, 2, 1)]


def test_shares_beyond_longs():
    big = np.array([0, 2**60], np.int64)
    assert audit.shares(big, 2**61, 3).tolist() == [1, 1 + 10**9 * (2**60 + 1) // (2**61 + 3)]
