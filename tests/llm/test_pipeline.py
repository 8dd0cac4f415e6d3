"""The pipeline against its parts done plainly, and what it keeps."""

import pytest

import corpus_pipeline
from stockledger.llm import lines, pii, queries
from tests.llm import brute


def test_stages_hold_what_they_should(spark, data, documents, run_dir):
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{run_dir}/{i}")
        before, docs = docs, spark.read.parquet(f"{run_dir}/{i}")
        out[name] = {r.doc_id: r for r in docs.collect()}
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
    texts = dict(documents)
    rejected = {r.doc_id for r in lines.quality_rules(spark.read.parquet(f"{data}/documents.parquet")).collect() if not r.kept}
    kept = {d: t for d, t in texts.items() if d not in rejected}
    assert set(out["quality_rules"]) == set(kept)
    firsts = {d: t for d, t in kept.items() if brute.linked(kept)[d][1] == d}
    assert set(out["ngram_jaccard"]) == set(firsts)
    items = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    clean = set(out["decontamination"])
    assert clean <= set(firsts) and not any(x in (firsts[d] or "") for d in clean for x in items)
    assert {d for d, t in firsts.items() if not any(brute.shingles(x) & brute.shingles(t) for x in items)} <= clean
    for d, r in out["pii"].items():
        assert r.n_chars == len(r.text) and not brute.base_spans(firsts[d] or "") or r.text != firsts[d]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    for d, r in out["sentencepiece"].items():
        ids = library.encode(out["pii"][d].text or "", add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
    got = corpus_pipeline.run(spark, data)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in out["sentencepiece"].values()}


@pytest.mark.parametrize("empty", [True, False])
def test_stages_take_awkward_rows(spark, data, framed, awkward, empty):
    rows = [] if empty else awkward
    frame = framed(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, data)
        if name == "quality_rules":
            assert {(r.doc_id, r.text) for r in out.collect()} <= {(d, t) for d, t in rows if len(brute.WORDS.findall(t or "")) >= 50}
        elif name == "ngram_jaccard":
            ids = [r.doc_id for r in out.collect()]
            assert set(ids) <= {d for d, _ in rows} and ids.count(900_005) == (0 if empty else 1)
        else:
            assert out.count() == len(rows)


def test_frequent_lines_of_a_large_host(spark, data, framed):
    """Texts that are mostly a line which 60 texts share are rejected, however many other texts their host has."""
    own, menu = " ".join(f"w{i}" for i in range(60)), " ".join(f"menu{i}" for i in range(80))
    rows = [(3 * i + 1, f"{own} {i}" + (f"\n{menu}" if i < 60 else f"\nrare {menu}" if i < 109 else "")) for i in range(600)]
    got = {r.doc_id for r in corpus_pipeline.quality(spark, framed(rows), data).collect()}
    assert got == {3 * i + 1 for i in range(60, 600)}


def test_frequent_lines_leave_the_texts(spark, data, framed):
    """Kept texts go on without the lines that too many texts share, all else as it was; n_chars follows."""
    own = {i: "\n".join(" ".join(f"w{i}x{k}y{j}é" for j in range(20)) for k in range(3)) for i in range(63)}
    rows = [(3 * i + 1, f" {own[i]}\n\n{'SHARED  Menu' if i % 2 else 'Shared menu '}\tline\nlast\u00a0 {i}\n") for i in range(60)]
    rows += [(9000, f"{own[60]}\nShared menu line"), (None, f"{own[61]}\nshared Menu line"), (9001, f"{own[62]}\n\n")]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.quality(spark, framed(rows), data).collect()}
    for d, t in rows:
        here = d is None or d % 3  # a source of its own has the others
        want = "\n".join(x for x in t.split("\n") if "shared" not in x.lower()) if here else t
        assert got[d] == (want, len(want) if want != t else 0)
