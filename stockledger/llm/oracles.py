"""SQL twins of the text queries, for DuckDB over the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLAIN = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_PLAIN)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a AS doc_id, a AS seen FROM e UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""


def op7(min_documents: int, min_share: float, min_kept_share: float) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, host, t, {_WORDS.format("t")} AS w FROM d),
g AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 1))) AS i)),
o AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g),
q AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM o WHERE n > 1) x GROUP BY r),
l AS (SELECT r, host, t, line, {_WORDS.format(f"translate(line, '{_UPPER}', '{_LOWER}')")} AS lw
    FROM d, LATERAL (SELECT unnest(string_split(t, chr(10))) AS line)),
f AS (SELECT r, host, t, line, array_to_string(lw, ' ') AS x, len(lw) AS n FROM l WHERE len(lw) > 0),
u AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM f GROUP BY r),
h AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY 1),
m AS (SELECT host, x FROM f JOIN h USING (host) GROUP BY host, x, h.n
    HAVING count(DISTINCT t) >= {min_documents} AND count(DISTINCT t) >= h.n * {min_share}),
z AS (SELECT r, sum(f.n) AS n FROM f JOIN m ON m.host = f.host AND m.x = f.x GROUP BY r),
a AS (SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines,
    coalesce(q.n, 0) AS n_repeat_words, coalesce(z.n, 0) AS n_removed_words
    FROM w LEFT JOIN q USING (r) LEFT JOIN u USING (r) LEFT JOIN z USING (r)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND n_words - n_removed_words >= {min_kept_share} * n_words AS kept,
    CAST(n_removed_words AS BIGINT) AS n_removed_words FROM v"""


OP8 = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(replace(replace(t, '&', '&amp;'), '<', '&lt;')) AS n,
    length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS k FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
    CAST(coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(9 + sum(n + k + 12) AS BIGINT) AS formatted_chars
FROM e GROUP BY 1"""


_TERMS = rf"regexp_extract_all({_PLAIN}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY 1, 2, 3),
s AS (SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN v USING (lang)
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2, 3),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n + s.v) AS p
    FROM s JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
w AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // ((SELECT sum(s.n) FROM s WHERE s.lang = p.lang) + any_value((SELECT v.v FROM v WHERE v.lang = p.lang))) AS q
    FROM p GROUP BY 1, 2),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
    coalesce((SELECT sum((a.p - b.p) * (a.p - b.p) // b.p) FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term
        WHERE a.lang = x.lang AND a.source = x.source AND b.source = y.source), 0) AS value
    FROM g x JOIN g y ON y.lang = x.lang AND y.source <> x.source
    UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - w.q) * (p.p - w.q) // w.q FROM p JOIN w USING (lang, term) WHERE p.n > 0 AND p.p > w.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM a QUALIFY part = 'pair' OR rank <= 200"""


def op12(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    far = "CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    ctes = [
        f"""e AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
    FROM embeddings WHERE len(embedding) = {dims} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {dims})""",
        "v AS (SELECT * FROM e)",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c, e
    FROM v QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        ctes.append(f"a{i} AS (SELECT v.r, min(ROW({far}, c.c)) AS near FROM v, c{i} c GROUP BY 1)")
        if i < rounds:
            ctes.append(f"""s{i} AS (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT a.near[2] AS c,
    unnest(v.e) AS x, unnest(range({dims})) AS i FROM v JOIN a{i} a USING (r)) GROUP BY 1, 2),
m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM s{i} GROUP BY 1),
c{i + 1} AS (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c)""")
    return f"""
WITH {", ".join(ctes)}
SELECT v.vec_id, CAST(a.near[2] AS INTEGER) AS cluster, CAST(a.near[1] AS BIGINT) AS distance,
    CAST(sum(a.near[1]) OVER (PARTITION BY a.near[2]) AS BIGINT) AS cluster_inertia,
    CAST(sum(a.near[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} c ON c.c = a.near[2]"""


OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS n, arg_min(r, doc_id) AS stays FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, CAST(g.n AS BIGINT) AS group_size, d.r = g.stays AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON g.t = d.t"""
