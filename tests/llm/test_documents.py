"""Line rules, pieces, chats, shards, quality scores, string tiling."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stockledger.llm import chat, lines, pieces, quality, queries, shards, tiling
from tests.llm import brute


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


def test_pieces_equal_the_library(framed, documents, awkward, library):
    rows = [*documents[:60], *((d, t) for d, t in awkward), (5_000_000, "<s>x</s> <unk> ⁇  ")]
    got = defaultdict(list)
    for r in pieces.encode_decode(framed(rows), queries.piece_model(), keep_texts=True).collect():
        got[r.doc_id].append((r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256))
    want = defaultdict(list)
    for d, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want[d].append((len(ids), ids, brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids))))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


def test_piece_table_starts_over(monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_CHARS", 100)
    table = pieces.ChunkTable(queries.piece_model())
    for text in ("some words to fill the table", "and  some more", "words again"):
        assert [i for c in pieces.chunks(text) for i in table.ids(c)] == library.encode(text)
        [table[c] for c in pieces.chunks(text)]
        table.trim()
    assert len(table) == 0


def test_line_rules_equal_brute_force(spark, data, documents):
    texts = dict(documents)
    for r in queries.op7_line_frequency(spark, data).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.counts(texts[r.doc_id])


def test_frequent_lines_of_a_host(spark, framed, awkward):
    """Lines that many texts of one host share are removed there; copies of one text count once."""
    own = " ".join(f"w{i}" for i in range(60))
    boiler = " ".join(f"Menu{i}" for i in range(70))
    rows = [(3 * i + 1, f"{own} {i}\n{boiler.upper() if i % 2 else boiler}") for i in range(20)]
    rows += [(1000 + 3 * i, f"copied {own}") for i in range(20)] + [(3003, f"{own} x\n{boiler}")]
    got = {r.doc_id: r for r in lines.quality_rules(framed(rows), min_documents=10).collect()}
    assert all(got[3 * i + 1].n_removed_words == 70 and not got[3 * i + 1].kept for i in range(20))
    assert all(got[1000 + 3 * i].kept for i in range(20)) and got[3003].kept
    result = lines.quality_rules(framed(awkward)).collect()
    assert len(result) == len(awkward)
    assert lines.quality_rules(framed([])).count() == 0
    for r in result:
        if r.doc_id not in (None, 900_006):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.counts(dict(awkward)[r.doc_id])


def test_chats_read_back(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = defaultdict(list)
    for c, t, r, x in rows:
        turns[c].append((t, r, x or ""))
    for r in queries.op8_chat_formatting(spark, data).collect():
        own = sorted(turns[r.conv_id])
        spoken = "".join(x for _, role, x in own if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(own), len(spoken), brute.sha(spoken))
        assert r.turns_sha256 == brute.sha("".join(f"{role}\n{x}\n" for _, role, x in own))


def test_chat_parts_and_awkward_turns(spark):
    nasty = "<|end|> &lt; &amp;gt; <|assistant|>\n|> <"
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    rows = [
        (1, 0, "user", [part("text", "see "), part("image", ref="a.png", units=2), part(None, nasty), part("audio", ref="b.wav")]),
        (1, 1, "assistant", [part("text", nasty), part("odd<kind>", ref="c")]),
        (2, None, None, None), (2, 0, "a|>\n<b", []), (2, 0, "a|>\n<b", []), (None, 5, "assistant", [part("text", None)]),
    ]
    schema = f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}"
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(spark.createDataFrame(rows, schema))).collect()}
    one, two = got[1], got[2]
    assert [t.role for t in one.turns] == ["user", "assistant"]
    assert one.turns[0].text == f"see <|image:1|>{nasty}<|audio:3|>"
    assert one.loss_text == one.turns[1].text == f"{nasty}<|odd<kind>:1|>"
    assert [(a.turn, a.place, a.type, a.ref, a.expanded_tokens) for a in one.attachments] == [
        (0, 1, "image", "a.png", 512), (0, 3, "audio", "b.wav", 25), (1, 1, "odd<kind>", "c", 1)]
    assert one.expanded_tokens == 538 and one.formatted.count(chat.END) == 2
    assert [t.role for t in two.turns] == ["", "a|>\n<b", "a|>\n<b"] and two.loss_text == ""
    assert got[None].n_turns == 1 and got[None].loss_text == ""
    assert chat.format_chat(spark.createDataFrame([], schema)).count() == 0


def _sharded(df):
    by_shard = defaultdict(list)
    for r in df.collect():
        by_shard[r.shard].append((r.slot, r.size))
    for rows in by_shard.values():
        assert sorted(s for s, _ in rows) == list(range(len(rows)))
    return {s: sum(size or 0 for _, size in rows) for s, rows in by_shard.items()}


def test_shards_are_even(spark, data):
    df = queries.op9_histogram_sort(spark, data)
    sizes = _sharded(df)
    largest = df.agg({"size": "max"}).first()[0]
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 2 * largest


@pytest.mark.parametrize("rows", [[], [(1, 5)], [(1, None)] * 9, [(7, 3)] * 3000, [(i, 1 + 10**6 * (i == 5)) for i in range(500)]])
def test_shards_of_awkward_rows(spark, rows):
    """No rows, nulls, one row that is repeated, one row that is larger than a shard."""
    df = spark.createDataFrame([(d, s, "x") for d, s in rows], "doc_id bigint, bytes bigint, n string")
    out = shards.shard_by_bytes(df.withColumnRenamed("bytes", "bytes"), "bytes", 5, ["doc_id"])
    assert out.count() == len(rows) and {"doc_id", "bytes", "n", "shard", "slot"} == set(out.columns)
    sizes = _sharded(out.withColumnRenamed("bytes", "size"))
    if len(rows) == 3000:
        assert len(sizes) == 5 and max(sizes.values()) - min(sizes.values()) <= 12
    with pytest.raises(ValueError, match="reserved"):
        shards.shard_by_bytes(df.withColumnRenamed("n", "piece"), "bytes", 5, ["doc_id"])


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op6_random_indexing(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    judged = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and sum(p == y for p, y in judged) >= 0.9 * len(judged)


def test_quality_of_awkward_rows(spark, framed, awkward):
    labels = spark.createDataFrame([(900_000, 1), (900_003, None), (None, 0)], "doc_id bigint, quality int")
    got = quality.quality_scores(framed(awkward), labels).collect()
    assert len(got) == len(awkward) and len({r.score for r in got}) == 1
    assert quality.quality_scores(framed([]), labels).count() == 0


def test_held_out_labels_do_not_matter(spark, framed, documents):
    known = [(d, d % 2) for d, _ in documents]
    other = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, y in known]
    scores = [
        {r.doc_id: r.score for r in quality.quality_scores(framed(documents), spark.createDataFrame(x, "doc_id bigint, quality int")).collect()}
        for x in (known, other)
    ]
    assert scores[0] == scores[1]


def test_tiles_equal_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 16))]
        text = [rng.randrange(4) for _ in range(rng.randrange(1, 24))]
        found = tiling.tiles(np.array(item, np.uint64), np.array(text, np.uint64), 2)
        used_a, used_b = set(), set()
        for i, j, k in found:
            assert item[i : i + k] == text[j : j + k] and k >= 2
            assert not used_a & set(range(i, i + k)) and not used_b & set(range(j, j + k))
            used_a |= set(range(i, i + k))
            used_b |= set(range(j, j + k))
        assert sum(k for _, _, k in found) == brute.tiled(item, text, 2)


def test_benchmark_items_are_found(spark, data, documents):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.op10_string_tiling(spark, data).collect()}
    assert {(d, i) for d, t in documents for i, x in items.items() if x in (t or "")} <= got


def test_reordered_passages_and_awkward_rows(spark, framed, awkward, monkeypatch):
    monkeypatch.setattr(tiling, "FILTER_BITS", 64)  # a filter that lets nearly everything through
    monkeypatch.setattr(tiling, "HEAP", 1)  # and each item by itself
    words = [f"w{i}" for i in range(40)]
    turned = words[30:] + ["gap"] + words[:12] + ["gap"] + words[12:30]
    rows = [(1, "so " + " ".join(turned).upper() + "!"), (2, " ".join(words[:18])), (3, " ".join(reversed(words)))]
    items = spark.createDataFrame(
        [("a", ", ".join(words), 1), ("b", None, 1), ("c", "", 1), ("d", "w1 w2", 1), ("a", ", ".join(words), 1)], "item_id string, text string, doc_id int"
    )
    got = tiling.contaminated(framed(rows + awkward), items).collect()
    assert [(r.doc_id, r.item_id, r.n_tiles, r.tiled_words, r.coverage) for r in got] == [(1, "a", 3, 40, 1.0)] * 2
    clean = tiling.decontaminated(framed(rows + awkward), items)
    assert clean.columns == framed(rows).columns and clean.count() == len(rows + awkward) - 1
    assert clean.where("doc_id = 1").count() == 0
    assert tiling.contaminated(framed([]), items).count() == 0
    assert tiling.contaminated(framed(rows), items.limit(0)).count() == 0
