"""Personal data: base spans against plain patterns, the model, redaction."""

import math

from stockledger.llm import pii, queries
from tests.llm import brute

TEXT = (
    "mail a@b.c_x@d.e ip 1.2.3.4.5.6.7.8 and 256.1.1.1 or 001.02.3.255. card 4111 1111 1111 1111 or 4111111111111112, "
    "call +1 (212) 555-0100 or +12 é🤖 x@y.zz@w.vv"
)


def digest(spans):
    return brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def test_base_spans_equal_the_patterns(spark, data, documents):
    want = {d: brute.base_spans(t or "") for d, t in documents}
    got = queries.op1_boosted_pii(spark, data).collect()
    assert len(got) == len(documents)
    for r in got:
        spans = want[r.doc_id]
        assert r.base_sha256 == digest(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(f"{k}:{a}:{b}" for k, a, b in spans) <= set(r.spans.split(",")) | {""}


def test_awkward_rows(framed, awkward):
    rows = [*awkward, (1, TEXT), (2, "+" * 50_000), (3, "1" * 100_000), (4, "1 " * 5_000 + "@" * 100)]
    got = pii.personal_data(framed(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 900_000:
            spans = [(s.kind, s.start, s.end) for s in r.spans if s.base]
            assert spans == brute.base_spans(dict(rows)[r.doc_id])
    assert pii.personal_data(framed([])).count() == 0


def test_redaction_replaces_each_span_once(framed):
    rows = [(1, TEXT), (2, "nothing here"), (3, None), (3, None)]
    out = pii.redact(framed(rows))
    assert out.columns == framed(rows).columns
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert (2, "nothing here") in texts and (3, None) in texts
    changed = next(t for d, t in texts if d == 1)
    assert "[EMAIL]" in changed and "[CARD]" in changed and "[PHONE]" in changed and "4111 1111" not in changed
    assert changed.endswith("é🤖 [EMAIL]@w.vv")


def test_trees_learn_a_format(spark):
    """Loose candidates that look like valid ones are taken, those that look like invalid ones are not."""
    texts = [(i, f"phone: +1 (212) 555-{i:04d} and 9999 8888 7777 {i:04d} end") for i in range(400)]
    found = pii.candidates(spark.createDataFrame(texts, "doc_id bigint, text string"))
    model = pii.fit(found.select("doc_id", "found"))
    assert model.trees and model.thresholds["phone"] < math.inf
    assert all(model.score(dict.fromkeys(pii.FEATURES, 0)) < 20 for _ in range(1))


def test_loose_spans_do_not_depend_on_the_mix(framed):
    """True loose spans are taken and false ones are not, whether a hundredth or half of the candidates are false."""
    true = {
        "email": "joe{i} @ host{i}.com", "ip": "2001:db8:0:1:0:0:{i:x}:a1", "card": "4111.1111.1111.1111", "phone": "(212) 555-{i:04d}",
    }
    false = {"email": "word{i} @ word{i}.Then", "ip": "256.1.{i}.999", "card": "9999.8888.7777.6666", "phone": "+1 {i:04d}"}
    for every in (100, 2):
        rows, want = [], {}
        for n in range(800):
            kind, i = pii.KINDS[n % 4], n // 4
            wrong = i % every == 1
            span = (false if wrong else true)[kind].format(i=i)
            rows.append((n, f"so {span}. Then {span if n % 8 < 4 else 'more'}"))
            want[n] = [] if wrong else [(kind, 3, 3 + len(span))] + [(kind, 10 + len(span), 10 + 2 * len(span))] * (n % 8 < 4)
        got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.personal_data(framed(rows)).collect()}
        assert {n: (got[n], want[n]) for n in want if got[n] != want[n]} == {}


def _loose_emails(texts, framed):
    got = pii.personal_data(framed(list(enumerate(texts)))).collect()
    return [len([s for s in r.spans if s.kind == "email"]) for r in sorted(got, key=lambda r: r.doc_id)]


def test_trees_decide(framed, monkeypatch):
    """Without the trees all candidates of a kind have one score, and all or none are taken."""
    texts = [f"so joe{i} @ host{i}.{'com' if i % 2 else 'Then'} it" for i in range(400)]
    assert _loose_emails(texts, framed) == [i % 2 for i in range(400)]
    monkeypatch.setattr(pii, "ROUNDS", 0)
    assert len(set(_loose_emails(texts, framed))) == 1


def test_context_alone_decides(framed):
    """Spans of one format, right where a cue is before them and wrong elsewhere; the model then goes by the cue."""
    texts = [f"{'mail' if i % 2 else 'seen'} joe{i % 7} @ host.{'com' if i % 2 else 'zzz'} it" for i in range(400)]
    texts += ["mail joe1 @ host.zzz it", "seen joe1 @ host.com it"]
    assert _loose_emails(texts, framed) == [*(i % 2 for i in range(400)), 1, 0]


def test_calibration_never_falls():
    assert pii.calibrated([(0.1, 1, 4), (0.2, 0, 4), (0.3, 3, 4), (0.3, 1, 4), (0.4, 9, 9)]) == [
        (0.1, 0.125), (0.2, 0.125), (0.3, 0.5), (0.4, 1.0),
    ]
    assert pii.calibrated([]) == []
