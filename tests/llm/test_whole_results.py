"""Text operators against brute force over whole small tables: passages by pairs, benchmark items, slots, samples, verdicts."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockledger.llm import chat, lines, passages, quality, queries, shards, tiling
from stockledger.llm.components import components
from stockledger.llm.shared import place_bound
from tests.llm import brute


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def joined(pairs):
    """The class of every id in pairs, as its smallest member."""
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


# Near-duplicate passages.


def test_every_holder_of_a_verbatim_passage_is_linked(framed):
    """Passages of 50 words in several documents, with smaller documents that hold a part of them only, copies, and crowds."""
    rng, rows, holders = random.Random(11), [], []
    ids = itertools.count(1)
    for part in (34, 38, 42, 45, 48) * 3:
        passage = words(rng, 50)
        cut = rng.choice([passage[:part], passage[-part:], passage[2 : 2 + part]])
        rows += [(next(ids), " ".join(words(rng, 100) + cut + words(rng, 100))) for _ in range(rng.choice([1, 3]))]
        own = []
        for _ in range(rng.choice([2, 2, 5, 30])):
            own.append(next(ids))
            rows.append((own[-1], " ".join(words(rng, rng.choice([0, 30, 100])) + passage + words(rng, rng.choice([0, 30, 100])))))
        if rng.random() < 0.5:
            own.append(next(ids))
            rows.append((own[-1], rows[-1][1]))
        holders.append(own)
    got = {(r.a, r.b) for r in passages.near_passages(framed(rows)).collect()}
    of = joined(got)
    for own in holders:
        assert len({of.get(d, d) for d in own}) == 1
    # And nothing else: every link is of two documents that do have similar passages.
    texts = dict(rows)
    for r in passages.near_passages(framed(rows)).collect():
        x, y = (brute.shingles(" ".join(texts[d].split()[a:b])) for d, a, b in ((r.a, r.a_start, r.a_end), (r.b, r.b_start, r.b_end)))
        assert len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.75
        assert min(r.a_end - r.a_start, r.b_end - r.b_start) >= 50


def test_near_passages_are_mostly_found(framed):
    """Passages of 100 words with words changed, similarity 0.75 to 0.85, in documents of their own."""
    rng, rows, pairs = random.Random(12), [], []
    while len(pairs) < 120:
        first = words(rng, 100)
        second = list(first)
        for i in rng.sample(range(100), rng.randrange(2, 6)):
            second[i] = words(rng, 1)[0]
        a, b = brute.shingles(" ".join(first)), brute.shingles(" ".join(second))
        if 0.75 <= len(a & b) / len(a | b) < 0.85:
            n = len(rows)
            rows += [(n + i, " ".join(words(rng, 80) + p + words(rng, 80))) for i, p in enumerate((first, second))]
            pairs.append((n, n + 1))
    got = {(r.a, r.b) for r in passages.near_passages(framed(rows)).collect()}
    assert sum(p in got for p in pairs) >= 0.9 * len(pairs)


def test_text_that_repeats_itself_is_verified_quickly():
    rng = np.random.default_rng(5)
    lines_ = [rng.integers(1, 2**62, 30).astype(np.uint64) for _ in range(6)]
    x = np.concatenate([lines_[i] for i in rng.integers(0, 6, 400)] + [np.arange(1, 61, dtype=np.uint64)])
    y = np.concatenate([rng.integers(1, 2**62, 9000).astype(np.uint64), *[lines_[i] for i in rng.integers(0, 6, 400)], np.arange(1, 61, dtype=np.uint64)])
    found = passages.verified(x, y)
    assert found and all(r[4] >= 0.75 for r in found)


@pytest.mark.parametrize("sizes", [[], [45], [46], [300], [10, 60, 0, 200, 47]])
def test_blocks_of_every_passage_are_chosen(sizes):
    """Of the blocks in a run of SHORTEST shingles the smallest is chosen, wherever the run is in its document."""
    rng = np.random.default_rng(len(sizes))
    own = [rng.integers(0, 2**40, n).astype(np.uint64) for n in sizes]
    whole = np.concatenate(own) if own else np.zeros(0, np.uint64)
    places, hashes = passages.blocks(whole, np.cumsum(sizes))
    fitting = passages.SHORTEST - passages.BLOCK + 1
    by_content = {}
    for p, h in zip(places.tolist(), hashes.tolist()):
        assert by_content.setdefault(whole[p : p + passages.BLOCK].tobytes(), h) == h
    begin = 0
    for n in sizes:
        for start in range(begin, begin + n - passages.SHORTEST + 1):
            assert any(start <= p < start + fitting for p in places)
        begin += n
    repeated = np.concatenate([whole, whole])
    again = passages.blocks(repeated, np.array([len(whole), 2 * len(whole)]))[1]
    assert Counter(again.tolist()) == Counter(hashes.tolist() * 2) or not sizes or len(sizes) > 1


# Benchmark items.


def test_contaminated_documents_equal_brute_force(spark, framed):
    rng = random.Random(21)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(f"item{i}", " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 12, 30, 40])))) for i in range(14)]
    items += [("word", "same " * 12), ("twin", items[3][1])]
    rows = []
    for d in range(60):
        text = rng.choices(vocabulary, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(0, 3)):
            held = rng.choice(items)[1].split()
            a = rng.randrange(0, max(1, len(held) - 6))
            at = rng.randrange(0, len(text) + 1)
            text[at:at] = held[a : a + rng.randrange(5, 30)]
        rows.append((d, " ".join(text)))
    rows += [(90, "same " * 300), (91, None), (91, rows[5][1]), (92, items[4][1].upper() + "!")]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id string, text string, row int, seeds int")
    got = Counter((r.doc_id, r.item_id, r.tiled_words, r.item_words) for r in tiling.contaminated(framed(rows), frame).collect())
    want = Counter()
    for (d, t), (i, x) in itertools.product(rows, items):
        item, text = ([w for w in tiling.plain_words((s or "").encode())] for s in (x, t))
        if len(item) >= tiling.SEED and (n := brute.tiled(item, text, tiling.SEED)) >= tiling.MIN_COVERAGE * len(item):
            want[d, i, n, len(item)] += 1
    assert got == want and len(got) > 20


def test_registered_items_equal_brute_force(spark, data, documents):
    """The whole query: documents that share a seed with an item, tiled plainly."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.tiled_words for r in queries.op10_string_tiling(spark, data).collect()}

    def seeds(ws):
        return {tuple(ws[i : i + tiling.SEED]) for i in range(len(ws) - tiling.SEED + 1)}

    split = {i: tiling.plain_words((t or "").encode()) for i, t in items.items()}
    by_seed = defaultdict(set)
    for i, ws in split.items():
        for s in seeds(ws):
            by_seed[s].add(i)
    want = {}
    for d, t in documents:
        text = tiling.plain_words((t or "").encode())
        for i in {i for s in seeds(text) for i in by_seed.get(s, ())}:
            shared = seeds(text) & seeds(split[i])
            near = sorted({p for at in range(len(text)) if tuple(text[at : at + tiling.SEED]) in shared for p in range(at, at + tiling.SEED)})
            if tiling.SEED * len(shared) * 3 < tiling.MIN_COVERAGE * len(split[i]) and len(near) < 5:
                continue
            # Only words in shared seeds can be in tiles; anything between them is a word no item has.
            short, before = [], None
            for p in near:
                short += [text[p]] if before in (None, p - 1) else [b"\0", text[p]]
                before = p
            n = brute.tiled(split[i], short, tiling.SEED) if len(short) < 400 else None
            if n is None or n >= tiling.MIN_COVERAGE * len(split[i]):
                want[d, i] = n
    for pair, n in want.items():
        assert n is None or got[pair] == n
    assert {p for p in got if p not in want} == set()


def test_seed_filter_has_all_it_was_given(spark):
    rng = np.random.default_rng(4)
    given = rng.integers(0, 2**63, 3000).astype(np.int64) - 2**62
    found = tiling.seed_filter(spark.createDataFrame([(int(x),) for x in given], "seed bigint").repartition(3))
    assert found.has(given.view(np.uint64)).all()
    assert found.has(rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.05


def test_repeated_words_take_linear_work():
    item, text = np.full(60, 7, np.uint64), np.full(30_000, 7, np.uint64)
    assert tiling.tiles(item, text) == [(0, 0, 60)]
    mixed_up = np.tile(np.array([7, 7, 7, 7, 7, 8], np.uint64), 5000)
    assert sum(n for _, _, n in tiling.tiles(np.full(50, 7, np.uint64), mixed_up)) == 50


# Shards.


def test_slots_follow_the_keys_of_every_shard(spark, data, monkeypatch):
    """Slots are gapless in each shard whatever the pieces, and shards hold what lies between their splitters."""
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    for size in (7, 100_000):
        monkeypatch.setattr(shards, "PIECE_ROWS", size)
        out = shards.shard_by_bytes(df, "bytes", 6, ["doc_id"]).collect()
        assert Counter((r.doc_id, r.bytes) for r in out) == Counter((r.doc_id, r.bytes) for r in df.collect())
        slots = defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(6))
        total, largest = sum(r.bytes for r in out), max(r.bytes for r in out)
        for shard in slots:
            assert abs(sum(r.bytes for r in out if r.shard == shard) - total / 6) <= 2 * (largest + 0.002 * total / 6)


# Quality: tables and sample.


def test_context_table_equals_brute_force(framed):
    texts = ["The cat sat.", "the the Cat", "", None, "one", "a b c d e f é ü"]
    index, cache = quality.index_vectors(), quality.Rows()
    want = np.zeros((quality.DIMENSIONS, quality._ROWS))
    for t in texts:
        ws = (t or "").encode().split()
        rows, shapes, _ = quality._rows_of([(t or "").encode()], cache) if ws else ([], [], [])
        own = [index[w] + index[s] for w, s in zip(rows, shapes)]
        for i, (w, s) in enumerate(zip(rows, shapes)):
            for j in (i - 1, i + 1):
                if 0 <= j < len(own):
                    want[:, w] += own[j]
                    want[:, s] += own[j]
    want /= np.maximum(np.linalg.norm(want, axis=0), 1)
    got = quality.context_table(framed(list(enumerate(texts))))
    assert np.allclose(got, want, atol=1e-6)


@pytest.mark.parametrize("n", [1, 10, 999, 1000, 5000])
def test_place_bound_holds_the_smallest(spark, n):
    rng = random.Random(n)
    places = sorted({rng.randrange(-(2**63), 2**63) for _ in range(900)} | set(range(-50, 50)))
    bound = place_bound(spark.createDataFrame([(x,) for x in places], "place bigint").repartition(3), n)
    under = [x for x in places if x <= bound]
    assert under[:n] == places[:n] and len(under) <= 2 * n
    assert place_bound(spark.createDataFrame([], "place bigint"), n) == 2**63 - 1


def test_no_partition_sends_more_than_the_sample(spark, framed, documents):
    """The fitted rows do not depend on how the table is cut, and rows that are repeated count once; sums in numpy may differ in the last place."""
    labels = spark.createDataFrame([(d, d % 2) for d, _ in documents], "doc_id bigint, quality int")
    many = documents + documents[:40] * 3
    scores = [
        {(r.doc_id, round(r.score, 9)) for r in quality.quality_scores(framed(rows).repartition(k), labels, training_rows=50).collect()}
        for rows, k in ((many, 1), (many, 9))
    ]
    assert scores[0] == scores[1]


# Line rules.


def test_verdicts_equal_brute_force(framed, documents):
    """Lines above the limit, counted by hand: distinct texts of a host that hold them."""
    rng = random.Random(8)
    menu = [" ".join(f"menu{k}x{i}" for i in range(12)) for k in range(4)]
    rows = []
    for d, t in documents[:120]:
        extra = [rng.choice([m, m.upper(), f"  {m.replace(' ', '  ')} "]) for m in menu if rng.random() < 0.3]
        rows.append((d, "\n".join([*((t or "").split("\n")), *extra * rng.choice([1, 1, 4])])))
    rows += rows[:5]
    limit = 12

    def key(line):
        return " ".join(w.translate(brute._LOWER) for w in brute.WORDS.findall(line))

    host = {d: "src0" if d % 3 else "" for d, _ in rows}
    texts = defaultdict(set)
    for d, t in rows:
        for line in t.split("\n"):
            if key(line):
                texts[host[d], key(line)].add(t)
    often = {k for k, held in texts.items() if len(held) >= limit}
    want = Counter()
    for d, t in rows:
        n_words, *_, failed = brute.counts(t)
        lost = sum(len(brute.WORDS.findall(x)) for x in t.split("\n") if (host[d], key(x)) in often)
        want[d, lost, not failed and n_words - lost >= lines.MIN_KEPT_SHARE * n_words] += 1
    got = lines.quality_rules(framed(rows), min_documents=limit)
    assert Counter((r.doc_id, r.n_removed_words, r.kept) for r in got.collect()) == want
    assert len(often) >= 4 and any(lost for _, lost, _ in want)


def test_registered_limits_act(spark):
    got = queries.op7_line_frequency(spark, "/root/testdata/sf0.1")
    assert got.where("n_removed_words > 0").count() > 100


# Chats and components.


def test_chats_ignore_other_columns(spark):
    schema = f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}"
    rows = [(1, 0, "user", [("text", "a", None, None)]), (1, 1, "assistant", [("text", "b" * 200_000, None, None)])]
    plain = spark.createDataFrame(rows, schema)
    names = ["segment", "turns", "formatted", "loss_mask", "begin", "attached", "n_turns", "segments", "loss_text"]
    clashing = plain.select("*", *[F.lit(7).alias(c) for c in names])
    one, other = (chat.read_back(chat.format_chat(df)).collect() for df in (plain, clashing))
    assert one == other and len(one[0].loss_text) == 200_000


def test_components_without_ids(spark):
    """A link with a null end says nothing."""
    links = spark.createDataFrame([(1, 2), (None, 2), (3, None), (None, None), (5, 5)], "a bigint, b bigint")
    assert {tuple(r) for r in components(links).collect()} == {(1, 1), (2, 1)}
