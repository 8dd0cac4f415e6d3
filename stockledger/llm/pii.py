"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds choose.

Four base patterns and looser ones propose overlapping candidates with their positions. Each candidate
is reduced to a few small integers about its format and its context. The trees are fitted on counts of
these over all candidates, labelled by the validator of their own form, which the trees do not see. On documents set aside the
scores are calibrated (isotonic regression), and a kind's threshold is the lowest score whose calibrated probability is high enough.
Valid base spans always stay; a looser candidate joins them if the model says so, whatever its own validator says, and it overlaps
no better span.

Texts are only touched by column expressions. The driver sees the table of counts, whose size is bounded by
the number of bins, and fits the trees on it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.shared import written

KINDS = ["email", "ip", "card", "phone"]

# Base patterns, written so that matching takes linear time and no recursion: a run is entered at its
# start only (or where the last match ended), and repeats never give anything back.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Looser forms of the same kinds; they overlap the base patterns and each other.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+"
    # A full stop with a space behind it only ends a sentence.
    r"(?:(?:\.|\x20\.\x20?|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}([\x20./_-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:00[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}

# Words near a candidate that speak for its kind.
CUES = {
    "email": r"(?i)mail|contact|write|@",
    "ip": r"(?i)\bip\b|host|server|address",
    "card": r"(?i)card|visa|credit|iban|account",
    "phone": r"(?i)phone|tel|call|mobile|fax",
}

FEATURES = ["kind", "digits", "length", "separators", "before", "after", "cue", "letters", "tail", "checksum", "largest"]

ROUNDS, DEPTH, RATE = 24, 3, 0.4

# Calibrated probability of being right from which on a looser span is taken.
TAKEN_FROM = 0.9

_DIGIT_BINS = (4, 7, 10, 13, 16, 20)
_LENGTH_BINS = (8, 12, 16, 20, 32, 64)


def _bin(value: Column, bounds: tuple[int, ...]) -> Column:
    return sum(((value >= b).cast("int") for b in bounds), F.lit(0))


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5)),
    )
    return F.aggregate(figures, F.lit(0).cast("bigint"), lambda n, d: n + F.coalesce(d, F.lit(0))) % 10 == 0


_PART = "0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


# Top-level domains a loose e-mail address may end in.
_DOMAINS = (
    "com|org|net|edu|gov|mil|int|arpa|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|cat|tel|asia|post|app|dev|xyz|online|"
    "site|shop|blog|tech|cloud|email|a[cdefgilmoqrstuwxz]|b[abdefghijmnorstvwyz]|c[acdfghiklmnoruvwxyz]|d[ejkmoz]|e[ceghrstu]|"
    "f[ijkmor]|g[abdefghilmnpqrstuwy]|h[kmnrtu]|i[delmnoqrst]|j[emop]|k[eghimnprwyz]|l[abcikrstuvy]|m[acdeghklmnopqrstuvwxyz]|"
    "n[acefgilopruz]|om|p[aefghklmnrstwy]|qa|r[eosuw]|s[abcdeghijklmnorstuvxyz]|t[cdfghjklmnortvwz]|u[agksyz]|v[aceginu]|w[fs]|"
    "y[et]|z[amw]"
)


def _valid(kind: str, text: Column, base: bool) -> Column:
    if not base and kind == "email":
        return text.rlike(rf"(?i)(?:\.|\(dot\)|\[dot\])\x20?(?:{_DOMAINS})$")
    if not base and kind == "ip":
        # Eight groups of which each has two digits are a hardware address or times.
        return ~text.rlike("^(?:[0-9A-Fa-f]{2}:){7}[0-9A-Fa-f]{2}$")
    digits = _only_digits(text)
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "ip":
        # A part of zeros only has none left for the pattern behind the zeros it skips.
        part = f"(?:{_PART}|0++)"
        return text.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    return F.lit(True)


def _with_places(texts: Column, pieces: Column) -> Column:
    """Matches and the text between them, as structs of start, end (code points) and match."""
    step = F.zip_with(texts, pieces, lambda m, p: F.struct(m.alias("m"), F.length(p).alias("gap")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int, m: string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["m"])
        here = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    return F.aggregate(F.filter(step, lambda x: x["m"].isNotNull()), start, add, lambda acc: acc["out"])


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (one text column, null as empty) with ``found``: an array of candidates by place.

    A candidate has kind, start, end, base (proposed by the base pattern), valid (by the kind's rule) and its features.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sources = [(k, True, p) for k, p in BASE.items()] + [(k, False, p) for k, p in LOOSE.items()]
    matched = docs.withColumns(
        {f"_m{i}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for i, (_, _, p) in enumerate(sources)}
    )
    none = F.array().cast("array<struct<start: int, end: int, m: string>>")
    placed = matched.withColumns(
        {
            f"_p{i}": F.when(F.size(f"_m{i}") > 0, _with_places(F.col(f"_m{i}"), F.split(text, p, -1))).otherwise(none)
            for i, (_, _, p) in enumerate(sources)
        }
    ).drop(*[f"_m{i}" for i in range(len(sources))])

    def described(kind: str, base: bool) -> Column:
        def one(x: Column) -> Column:
            m = x["m"]
            before = F.substr(text, F.greatest(x["start"] - 23, F.lit(1)), F.least(x["start"], F.lit(24)))
            near, behind = F.substr(text, x["start"], F.when(x["start"] > 0, 1).otherwise(0)), F.substr(text, x["end"] + 1, F.lit(1))
            digits = F.length(_only_digits(m))
            separators = F.length(F.regexp_replace(m, "[0-9A-Za-z]", ""))
            return F.struct(
                F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lit(base).alias("base"),
                _valid(kind, m, base).alias("valid"),
                F.struct(
                    F.lit(KINDS.index(kind)).alias("kind"), _bin(digits, _DIGIT_BINS).alias("digits"),
                    _bin(F.length(m), _LENGTH_BINS).alias("length"), F.least(separators, F.lit(8)).alias("separators"),
                    _class_of(near).alias("before"), _class_of(behind).alias("after"),
                    before.rlike(CUES[kind]).cast("int").alias("cue"), m.rlike("[A-Za-z]").cast("int").alias("letters"),
                    (_tail_of(m) if kind == "email" else F.lit(0)).alias("tail"),
                    F.when(digits >= 12, luhn(_only_digits(m)).cast("int")).otherwise(0).alias("checksum"),
                    _largest_in(m).alias("largest"),
                ).alias("features"),
            )

        return one

    found = F.concat(*[F.transform(f"_p{i}", described(k, b)) for i, (k, b, _) in enumerate(sources)])
    return placed.withColumn("found", found).drop(*[f"_p{i}" for i in range(len(sources))])


def _class_of(sign: Column) -> Column:
    """0 at an end of the text, 1 white space, 2 letter or digit, 3 anything else."""
    return F.when(sign == "", 0).when(sign.rlike(r"\s"), 1).when(sign.rlike(r"[0-9A-Za-z]"), 2).otherwise(3)


def _tail_of(text: Column) -> Column:
    """How the last label looks: 1 to 3 small letters (two, three, more), 4 a word with a capital, 5 capitals, 6 anything else."""
    last = F.regexp_extract(text, "([A-Za-z0-9-]+)$", 1)
    looks = ("[a-z]{2}", "[a-z]{3}", "[a-z]{4,}", "[A-Z][a-z]+", "[A-Z]+")
    out = F.lit(6)
    for i, pattern in reversed(list(enumerate(looks))):
        out = F.when(last.rlike(f"^{pattern}$"), i + 1).otherwise(out)
    return out


def _largest_in(text: Column) -> Column:
    """The largest number: 0 up to 255 or none, 1 up to 999, 2 more."""
    numbers = F.regexp_extract_all(text, F.lit("0*([0-9]+)"), F.lit(1))
    size = F.transform(numbers, lambda n: F.when(F.length(n) > 3, 2).when(n.cast("int") > 255, 1).otherwise(0))
    return F.coalesce(F.array_max(size), F.lit(0))


# The model: regression trees on small integers, boosted on counts.


@dataclass
class Model:
    base: float
    trees: list
    thresholds: dict[str, float]

    def score(self, features: dict[str, int]) -> float:
        return sum((_leaf(t, features) for t in self.trees), self.base)

    def score_column(self, features: Column) -> Column:
        return sum((_tree_column(t, features) for t in self.trees), F.lit(self.base))


def _leaf(tree, features: dict[str, int]) -> float:
    while isinstance(tree, tuple):
        name, bound, left, right = tree
        tree = left if features[name] <= bound else right
    return tree


def _tree_column(tree, features: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    name, bound, left, right = tree
    return F.when(features[name] <= bound, _tree_column(left, features)).otherwise(_tree_column(right, features))


def _grown(rows: list[tuple], depth: int) -> object:
    """A tree on rows of (features, slope, curvature): the split with the best gain, values by Newton steps."""
    slope, curve = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None)
    if depth:
        for name in FEATURES:
            by_value: dict[int, list[float]] = {}
            for x, g, h in rows:
                sums = by_value.setdefault(x[name], [0.0, 0.0])
                sums[0] += g
                sums[1] += h
            g, h = 0.0, 0.0
            for value in sorted(by_value)[:-1]:
                g, h = g + by_value[value][0], h + by_value[value][1]
                gain = g * g / (h + 1) + (slope - g) ** 2 / (curve - h + 1) - slope * slope / (curve + 1)
                best = max(best, (gain, (name, value)), key=lambda b: b[0])
    if best[1] is None:
        return RATE * slope / (curve + 1)
    name, value = best[1]
    sides = [r for r in rows if r[0][name] <= value], [r for r in rows if r[0][name] > value]
    return (name, value, _grown(sides[0], depth - 1), _grown(sides[1], depth - 1))


def fit(found: DataFrame) -> Model:
    """Trees and thresholds from all candidates of ``found`` (doc_id and the array of candidates).

    Documents whose hash is divisible by four are set aside for the calibration. Without
    candidates there are no trees and no looser span is taken.
    """
    each = found.select(
        (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("aside"), F.explode("found").alias("c")
    )
    counts = each.groupBy("aside", "c.features", "c.valid").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = [(r["features"].asDict(), float(r["valid"]), float(r["n"]), r["aside"]) for r in counts]
    train = [r for r in rows if not r[3]]
    right, total = sum(y * n for _, y, n, _ in train), sum(n for _, _, n, _ in train)
    model = Model(math.log((right + 1) / (total - right + 1)), [], dict.fromkeys(KINDS, math.inf))
    scores = [model.base] * len(train)
    for _ in range(ROUNDS if train else 0):
        slopes = []
        for (x, y, n, _), s in zip(train, scores):
            p = 1 / (1 + math.exp(-s))
            slopes.append((x, n * (y - p), n * p * (1 - p)))
        tree = _grown(slopes, DEPTH)
        model.trees.append(tree)
        scores = [s + _leaf(tree, r[0]) for s, r in zip(scores, train)]
    for i, kind in enumerate(KINDS):
        aside = [(model.score(x), y * n, n) for x, y, n, a in rows if a and x["kind"] == i]
        for score, probability in reversed(calibrated(aside)):
            if probability < TAKEN_FROM:
                break
            model.thresholds[kind] = score - 1e-6  # sums may differ in the last place
    return model


def calibrated(scored: list[tuple[float, float, float]]) -> list[tuple[float, float]]:
    """(score, probability) by score, never falling, of (score, right ones, all): neighbours that would fall are pooled."""
    by_score: dict[float, list[float]] = {}
    for score, good, n in scored:
        sums = by_score.setdefault(score, [0.0, 0.0])
        sums[0] += good
        sums[1] += n
    pools: list[list] = []
    for score in sorted(by_score):
        pools.append([[score], *by_score[score]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            scores, good, n = pools.pop()
            pools[-1] = [pools[-1][0] + scores, pools[-1][1] + good, pools[-1][2] + n]
    return [(score, good / n) for scores, good, n in pools for score in scores]


def chosen(found: DataFrame, model: Model) -> DataFrame:
    """``spans`` in place of ``found``: kind, start, end, base of what is to be redacted, by kind and place."""
    limits = F.create_map(*[F.lit(x) for k in KINDS for x in (k, float(model.thresholds[k]))])
    base = F.filter("found", lambda c: c["base"] & c["valid"])
    marked = found.withColumn("_base", base)

    def apart(a: Column, b: Column) -> Column:
        return (a["end"] <= b["start"]) | (b["end"] <= a["start"])

    loose = F.transform(
        F.filter("found", lambda c: ~c["base"] & ~F.exists("_base", lambda b: ~apart(b, c))),
        lambda c: c.withField("score", model.score_column(c["features"])),
    )
    marked = marked.withColumn("_loose", F.filter(loose, lambda c: c["score"] >= F.element_at(limits, c["kind"])))

    def better(a: Column, b: Column) -> Column:
        order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), a["kind"])
        other = F.array_position(F.array(*[F.lit(k) for k in KINDS]), b["kind"])
        return F.struct(b["score"], -b["start"], b["end"], -other) > F.struct(a["score"], -a["start"], a["end"], -order)

    kept = F.filter("_loose", lambda c: ~F.exists("_loose", lambda b: ~apart(b, c) & better(c, b)))
    rank = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_sort(
        F.transform(
            F.concat(F.col("_base"), F.transform(kept, lambda c: c.dropFields("score"))),
            lambda c: F.struct(
                F.array_position(rank, c["kind"]).alias("rank"), c["start"].alias("start"), c["end"].alias("end"),
                c["kind"].alias("kind"), c["base"].alias("base"),
            ),
        )
    )
    return marked.withColumn("spans", spans).drop("_base", "_loose", "found")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.array(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
        )

    whole = F.aggregate(
        by_place, start, add,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1, F.length(text) + 1)),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` of every row of ``docs``; see :func:`chosen`.

    Null and empty texts have no spans. Repeated rows give repeated rows, other columns do not
    matter, an empty table gives an empty one. Long texts are matched in linear time.
    """
    found = written(candidates(docs.select("doc_id", "text")).drop("text"))
    return chosen(found, fit(found))


def redact(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with personal data in its texts replaced; null texts stay null."""
    model = fit(candidates(docs.select("doc_id", "text")).drop("text"))
    own = docs.columns
    found = chosen(candidates(docs.select(F.struct(*own).alias("_row"), "text")), model)
    return found.withColumn("text", redacted(F.col("text"), F.col("spans"))).select(
        *[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in own]
    )
