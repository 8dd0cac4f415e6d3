"""Exact substrings, near passages, near documents."""

import random

import numpy as np
import pytest

from stockledger.llm import jaccard, passages, queries, suffixes
from stockledger.llm.components import components
from tests.llm import brute


def test_loser_tree_merges_and_knows_common_prefixes():
    rng = random.Random(1)
    for _ in range(60):
        runs, every = [], []
        for _ in range(rng.randint(1, 9)):
            own = sorted({bytes(rng.choice(b"ab\x00") for _ in range(50)) for _ in range(rng.randint(1, 20))})
            every += own
            runs.append(suffixes._front_coded(np.frombuffer(b"".join(own), np.uint8).reshape(-1, 50)))
        rows, at, out = [list(suffixes._rows_back(*r)) for r in runs], [0] * len(runs), []
        for i, shared in suffixes.LoserTree(runs):
            row = rows[i][at[i]]
            at[i] += 1
            if out:
                assert shared == next((k for k in range(50) if row[k] != out[-1][k]), 50)
            out.append(row)
        assert out == sorted(every)


def _removed(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_substrings_equal_brute_force(spark, data, documents):
    assert _removed(queries.op2_suffix_dedup(spark, data)) == brute.removed(documents)


def test_substrings_of_awkward_rows(framed, documents, awkward):
    rows = documents[:40] + [r for r in awkward if r[0] is not None and len(r[1] or "") < 10_000]
    assert _removed(suffixes.substring_dedup(framed(rows))) == brute.removed(rows)
    assert suffixes.substring_dedup(framed([])).count() == 0
    kept = suffixes.substring_dedup(framed(rows), keep_texts=True).collect()
    assert all(brute.sha(bytes(r.kept)) == r.kept_sha256 for r in kept)


def test_anchors_do_not_depend_on_pieces(documents, monkeypatch):
    texts = [(t or "").encode() for _, t in documents[:60]] + [b"", b"a" * 3000, b"xyz"]
    whole = suffixes._anchored(texts)
    monkeypatch.setattr(suffixes, "PIECE", 777)
    for x, y in zip(whole, suffixes._anchored(texts)):
        assert np.array_equal(x, y)


def test_folded_suffixes(framed):
    """A passage that more documents of a slice share than are folded."""
    passage = "a passage that is in every one of these documents, word for word and sign for sign."
    rows = [(i, f"start {i} {passage} end {i * 7919}") for i in range(60)]
    assert _removed(suffixes.substring_dedup(framed(rows))) == brute.removed(rows)


def test_compact_windows_are_the_cartesian_tree():
    rng = np.random.default_rng(1)
    for t in range(40):
        sizes = [int(x) for x in rng.integers(0, 40, 4)]
        values = rng.integers(0, 12 if t % 2 else 2**40, sum(sizes)).astype(np.uint64) + np.uint64(1)
        want, begin = set(), 0

        def grow(low, high):
            if high - low + 1 >= 5:
                centre = low + int(np.argmin(values[low : high + 1]))
                want.add((low, centre, high))
                grow(low, centre - 1)
                grow(centre + 1, high)

        for size in sizes:
            grow(begin, begin + size - 1)
            begin += size
        assert {tuple(x) for x in passages.compact_windows(values, np.cumsum(sizes), 5).tolist()} == want


def _words(text):
    return (text or "").lower().split()


def test_repeated_passages_are_found(spark, data, documents):
    got = queries.op3_compact_windows(spark, data).collect()
    texts, runs = dict(documents), {}
    for d, t in documents:
        words = _words(t)
        for i in range(len(words) - 59):
            runs.setdefault(tuple(words[i : i + 60]), set()).add(d)
    repeated = {d for holders in runs.values() if len(holders) > 1 for d in holders}
    assert repeated <= {r.doc_id for r in got} | {r.other_doc_id for r in got}
    for r in got[:200]:
        a, b = (brute.shingles(" ".join(_words(texts[d])[x:y])) for d, x, y in
                ((r.doc_id, r.a_start, r.a_end), (r.other_doc_id, r.b_start, r.b_end)))
        assert r.similarity == pytest.approx(len(a & b) / len(a | b)) and r.similarity >= 0.75


def test_stray_shingles_do_not_hide_a_passage(monkeypatch):
    """A phrase that both texts have at other distances from a passage; the passage is found all the same."""
    rng = np.random.default_rng(3)
    for same in (46, 60, 200):
        for limit in (10**6, 0):
            monkeypatch.setattr(passages, "MATCHES", limit)
            whole, stray = rng.integers(1, 2**62, same).astype(np.uint64), np.array([7], np.uint64)
            x, y = (np.concatenate([rng.integers(1, 2**62, 9), whole, rng.integers(1, 2**62, n), stray]).astype(np.uint64)
                    for n in (same // 4, same // 2))
            assert passages.verified(x, y) == [(9, 9 + same, 9, 9 + same, 1.0)]
            y[9 + same // 2 - 2 : 9 + same // 2 + 1] = rng.integers(1, 2**62, 3)  # and one that is not verbatim
            assert [r[:4] for r in passages.verified(x, y)] == [(9, 9 + same, 9, 9 + same)]
            two = passages.verified(np.concatenate([x, x[::-1]]), np.concatenate([y[::-1], y]))
            assert len(two) >= 2
            assert passages.verified(x[:54], y[55:]) == []


def test_passages_of_awkward_rows(framed, documents, awkward):
    passages_of = passages.near_passages(framed(documents[:20] + awkward)).collect()
    assert all(r.a < r.b for r in passages_of)
    assert passages.near_passages(framed([])).count() == 0


def test_near_copies_equal_brute_force(spark, data, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_ngram_jaccard(spark, data).collect()}
    assert got == brute.linked(dict(documents))


@pytest.mark.parametrize("crowd", [2, 8])
def test_near_copies_in_crowds(framed, monkeypatch, crowd):
    """Chains and crowds of near copies, with a passage most documents share."""
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    rng = random.Random(4)
    common = [f"c{i}" for i in range(25)]
    texts = []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(rng.choice([3, 5, 8, 12, 20, 40, 90]))]
        for _ in range(rng.choice([1, 2, 15])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                words[rng.randrange(len(words))] = f"n{rng.random()}"
            texts.append(" ".join(words + (common if rng.random() < 0.6 else [])))
            if rng.random() < 0.3:
                base = words
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(framed(rows)).collect()}
    assert got == brute.linked(dict(rows))


def test_near_copies_of_awkward_rows(framed, awkward):
    rows = [r for r in awkward if r[0] not in (900_006,)]
    got = jaccard.jaccard_join(framed(rows)).collect()
    want = brute.linked({d: t for d, t in rows if d is not None})
    assert len(got) == len(rows)
    for r in got:
        assert r.doc_id is None and r.component_id is None or (r.n_shingles, r.component_id) == want[r.doc_id]
    assert jaccard.jaccard_join(framed([])).count() == 0


def test_plans_promise_what_linked_sets_share():
    """Sets that just link share at least the signatures each is said to need."""
    rng = np.random.default_rng(2)
    bands = jaccard.band_starts(3000)
    plans = [jaccard.Plan(a, b) for a, b in zip(bands, bands[1:])]
    for _ in range(300):
        n = int(rng.integers(1, 900))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, n // 7 + 1))
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        band = int(np.searchsorted(bands, min(len(x), len(y)), side="right")) - 1
        sx, need_x = jaccard._signatures(x, band, plans[band])
        sy, need_y = jaccard._signatures(y, band, plans[band])
        assert len(np.intersect1d(sx, sy)) >= max(need_x, need_y)


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_hidden_links_meet_by_shingle(spark):
    """Sets that crowds may hide pair by a rare shingle they share, whatever the order of the columns that a join leaves."""
    sets = {10: [1, 2, 3, 4], 20: [1, 2, 3, 5], 30: [6, 7, 8, 9]}
    each = spark.createDataFrame([(t, label) for label, own in sets.items() for t in own], "token bigint, label bigint")
    named = spark.createDataFrame([(label // 10, label, 4, label // 10) for label in sets], "doc_id bigint, label bigint, n bigint, component bigint")
    assert [tuple(r) for r in jaccard._prefix_pairs(each, named).collect()] == [(10, 20)]


def test_near_copies_around_one_common_passage(framed):
    """Short documents of a passage all share: their segments are crowded, and some links are only found by rare shingles."""
    rng = random.Random(2)
    common, texts = [f"c{i}" for i in range(25)], []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(rng.choice((3, 5, 8, 12, 20, 40, 90, 300)))]
        for _ in range(rng.choice([1, 2, 15, 40])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                at, kind = rng.randrange(len(words)), rng.random()
                if kind < 0.4:
                    words[at] = f"n{rng.random()}"
                elif kind < 0.7:
                    del words[at]
                else:
                    words.insert(at, f"n{rng.random()}")
                words = words or ["z"]
            if rng.random() < 0.3:
                base = words
            texts.append(" ".join(words + (common if rng.random() < 0.6 else [])))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(framed(rows)).collect()}
    assert got == brute.linked(dict(rows))


def test_one_crowd_of_near_copies_is_not_verified_pair_by_pair(framed, monkeypatch):
    """Near copies, many of them too far from the first: links are those of all pairs, the texts compared a few for each row."""
    rng = random.Random(6)
    base, texts = [f"w{i}" for i in range(150)], []
    for k in range(160):
        words = list(base)
        for at in rng.sample(range(150), 3 if k == 0 else rng.choice([0, 1, 2, 3, 5, 7])):
            words[at] = f"n{k}x{at}"
        texts.append(" ".join(words))
    rows, compared, verified = list(enumerate(texts)), [], jaccard._verified

    def counted(pairs, docs):
        compared.append(pairs.count())
        return verified(pairs, docs)

    monkeypatch.setattr(jaccard, "_verified", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(framed(rows)).collect()}
    assert got == brute.linked(dict(rows))
    assert len(compared) > 1 and sum(compared[1:]) < 2 * len(rows)


def test_bits_and_places_lose_no_link(spark):
    """What places and bits exclude cannot link: against all pairs, sets of many sizes around shared shingles."""
    rng = np.random.default_rng(8)
    core, sets = rng.integers(1, 2**62, 60).astype(np.uint64), {}
    for k in range(120):
        kept = core[rng.random(60) < rng.choice([0.8, 0.9, 1.0])]
        sets[k] = np.unique(np.concatenate([kept, rng.integers(1, 2**62, int(rng.integers(0, 16))).astype(np.uint64)]))
    each = spark.createDataFrame([(int(t), k) for k, own in sets.items() for t in own.view(np.int64)], "token bigint, label bigint")
    named = spark.createDataFrame([(k, k, len(own), k) for k, own in sets.items()], "doc_id bigint, label bigint, n bigint, component bigint")
    bits = spark.createDataFrame([(k, jaccard._bits(own).tolist()) for k, own in sets.items()], "label bigint, bits array<bigint>")
    got = {tuple(r) for r in jaccard._prefix_pairs(each, named, bits).collect()}
    every = [(x, y) for x in sets for y in sets if x < y]
    links = {p for p in every if brute.link(frozenset(sets[p[0]].tolist()), frozenset(sets[p[1]].tolist()))}
    assert links and links <= got and len(got) < 0.8 * len(every)


def _repeating(rng, passage, repeats=40):
    """A passage between its own shingles in disorder, and foreign ones that keep the whole from being similar."""
    foreign = [rng.integers(1, 2**60, 900).astype(np.uint64) for _ in range(2)]
    mixed = [rng.permutation(np.repeat(passage, repeats)) for _ in range(2)]
    return np.concatenate([passage[:3], foreign[0], mixed[0], passage, mixed[1], foreign[1], passage[-3:]])


def test_repeated_shingles_do_not_hide_a_passage():
    rng = np.random.default_rng(5)
    passage = rng.integers(1, 2**60, 60).astype(np.uint64)
    x, y = _repeating(rng, passage), _repeating(rng, passage)
    at = 3 + 900 + 40 * 60
    assert [at, at, 60] in passages.aligned_runs(x, y).tolist()
    assert any(a <= at and at + 60 <= b and c <= at and at + 60 <= d for a, b, c, d, _ in passages.verified(x, y))
    # One shingle again and again on both sides of what differs: the runs are long, the whole is not alike.
    same = np.full(300, 7, np.uint64)
    x, y = (np.concatenate([same, rng.integers(10, 2**60, 100).astype(np.uint64), same]) for _ in range(2))
    assert {r[:4] for r in passages.verified(x, y)} >= {(0, 300, 0, 300), (400, 700, 400, 700)}


@pytest.mark.parametrize("limit", [0, 8])
def test_runs_equal_brute_force(monkeypatch, limit):
    monkeypatch.setattr(passages, "MATCHES", limit)
    monkeypatch.setattr(passages, "SEED", 4)
    rng = np.random.default_rng(6)
    for _ in range(60):
        x, y = (rng.integers(5, 5 + rng.choice([1, 2, 10]), rng.integers(1, 40)).astype(np.uint64) for _ in range(2))
        want = []
        for i in range(len(x)):
            for j in range(len(y)):
                if x[i] == y[j] and (i == 0 or j == 0 or x[i - 1] != y[j - 1]):
                    k = 0
                    while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                        k += 1
                    want.append([i, j, k])
        got = passages.aligned_runs(x, y).tolist()
        assert sorted(r for r in got if r[2] >= 4) == sorted(r for r in want if r[2] >= 4)
        if limit and len(want) <= limit * (len(x) + len(y)):
            assert sorted(got) == sorted(want)


def test_each_document_with_a_passage_has_rows(spark, data):
    got = {(r.doc_id, r.other_doc_id, r.a_start, r.a_end, r.b_start, r.b_end) for r in queries.op3_compact_windows(spark, data).collect()}
    assert got and {(b, a, *second, *first) for a, b, *ends in got for first, second in [(ends[:2], ends[2:])]} == got
