"""N-gram Jaccard join by partitioning the universe of shingles.

Documents are sets of five-word shingles; two link when 100 * intersection >= 75 * union. Sizes are cut into bands
so that linked sets lie in one band or in neighbours, and every band has a bound h on the shingles in which a set of it
and a linked set at least as large differ. Shingles are hashed into m > h segments. A segment is indexed as it is, and
then at least m - h segments agree, or with its one-deletion neighbourhood, and then at least m - h // 2 agree
but for one shingle; the cheaper of the two that rarely fails is chosen for each band.

Empty segments agree but are not indexed. So a set knows how many signatures a linked set shares with it at
least: those that must agree less its empty segments. Groups of a signature yield all their pairs if
they are small, and pairs with one of them if they are crowded; a pair is a candidate if the signatures it was seen
to share, and the crowded groups its sets are in, can reach that number. Sets whose crowded groups
alone could reach it, or that can promise nothing, are joined by a prefix of their rarest shingles too, where the places of
a shared one and a bitmap of either set allow a link. Candidates are verified on the texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.components import components
from stockledger.llm.shared import WordHashes, as_bytes, mixed, semi, shingles, slices, without, word_hashes, written, written_in_slices

# Sets with one signature all of whose pairs are looked at; in larger groups all pair with the first.
CROWD = 8

# Signatures one reducer sorts at once.
BUCKET_SIGNATURES = 3_000_000

# Bits that stand for a set where pairs are only compared if these are alike.
BITS = 1024

# Pairs under rare shingles, for each set under them, from which one set is compared with the others first.
PAIRS_A_ROW = 4


def _distinct(texts: list[bytes], cache: WordHashes) -> list[np.ndarray]:
    hashes, starts = word_hashes([t.lower().split() for t in texts], cache)
    return [np.unique(s) for s in shingles(hashes, starts)]


def _set_key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and set_key (equal for equal sets) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for part, texts in slices(batches):
            sets = _distinct(texts, cache)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_key(s) for s in sets])],
                names=["doc_id", "n_shingles", "set_key"],
            )

    return as_bytes(docs, "doc_id").mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary")


# Bands and segments.


def band_starts(largest: int) -> list[int]:
    """Smallest sizes of the bands; sets with a Jaccard of 3/4 lie in one band or in neighbours."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 4 // 3 + 1)
    return starts


class Plan:
    """How sets of a band, and larger ones of the band above, are signed: into how many segments, with deletions or without."""

    def __init__(self, low: int, high: int):
        self.h = (high - 1) // 3
        options = []
        for deletions, differing in ((False, self.h), (True, self.h // 2)):
            m, sure = self._sized(low, differing, deletions)
            options.append((sure, -(low + m if deletions else m), m, deletions, m - differing))
        _, _, self.segments, self.deletions, self.agreeing = max(options)

    def _sized(self, low: int, differing: int, deletions: bool) -> tuple[int, float]:
        """Fewest segments of which some say something in nearly all sets; how sure that is, 3 at most."""
        if differing == 0:
            return 1, 3.0
        best = (1, -math.inf)
        for m in range(differing + 1, 8 * differing + 16):
            load = low / m
            lost = m * math.exp(-load) * (1 + deletions * load)
            sure = min((m - differing - 1 - self.h / 16 - lost) / math.sqrt(lost), 3.0)
            if sure > best[1]:
                best = (m, sure)
            if sure == 3:
                break
        return best


def _signatures(tokens: np.ndarray, band: int, plan: Plan) -> tuple[np.ndarray, int]:
    """Hashes of the segments of a set, and how many of them a linked set has as well, at least."""
    salt = np.uint64((band + 1) * 0xC2B2AE3D27D4EB4F % 2**64)
    # Segments by the high bits of a hash of their own: no order of the shingles is favoured.
    spread = mixed(tokens + salt)
    segment = ((spread >> np.uint64(32)) * np.uint64(plan.segments) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    segment, weight = segment[order], mixed(spread[order] ^ np.uint64(0x5851F42D4C957F2D))
    starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    sums = np.add.reduceat(weight, starts)
    names = mixed(salt + segment[starts].astype(np.uint64))
    whole = mixed(sums + names)
    if not plan.deletions:
        return whole, plan.agreeing - (plan.segments - len(starts))
    counts = np.diff(np.append(starts, len(segment)))
    at = np.repeat(np.arange(len(starts)), counts)
    less = mixed(sums[at] - weight + names[at])[counts[at] > 1]  # a segment's last shingle is not deleted
    if plan.segments == 1:
        return np.concatenate([whole, less]), 1
    return np.concatenate([whole, less]), plan.agreeing - (plan.segments - len(starts)) - int((counts < 2).sum())


# Labels are 63 bits of a set's key and, lowest, whether the set signs for the band below its own.


def _label_of(tokens: np.ndarray) -> int:
    return int.from_bytes(_set_key(tokens)[:8], "big") & ~1


_SIGNED = "bucket bigint, owners binary, needed binary, counts binary, signs binary, ends binary"


def _signed(sets: Iterator[list[np.ndarray]], bands: list[int], plans: list[Plan], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per slice and bucket: labels, what each needs, how many signatures each has there, and the signatures."""
    for found in sets:
        signs, labels, needs = [], [], []
        for own in found:
            if not len(own):
                continue
            label, band = _label_of(own), int(np.searchsorted(bands, len(own), side="right")) - 1
            for above, b in ((0, band), (1, band - 1)):
                if b >= 0:
                    sign, need = _signatures(own, b, plans[b])
                    signs.append(sign)
                    labels.append(label | above)
                    needs.append(need)
        if not signs:
            continue
        sign, owner = np.concatenate(signs), np.repeat(np.arange(len(signs)), [len(x) for x in signs])
        label, need = np.array(labels, np.uint64), np.array(needs, np.int32)
        bucket = ((sign >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sign, owner, bucket = sign[order], owner[order], bucket[order]
        bounds = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        told = np.zeros(len(label), bool)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            firsts = np.flatnonzero(np.concatenate([[True], owner[a + 1 : b] != owner[a : b - 1]]))
            own = owner[a:b][firsts]
            # A set tells what it needs once, in the first bucket it is in.
            need_here = np.where(told[own], -(2**31), need[own]).astype(np.int32)
            told[own] = True
            out.append((
                int(bucket[a]), label[own].tobytes(), need_here.tobytes(), np.diff(np.append(firsts, b - a)).astype(np.uint32).tobytes(),
                sign[a:b].astype(np.uint32).tobytes(), (sign[a:b] >> np.uint64(32)).astype(np.uint8).tobytes(),
            ))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], pa.int64() if i == 0 else pa.binary()) for i in range(6)],
            names=[x.split()[0] for x in _SIGNED.split(", ")],
        )


# kind 0: x and y share n signatures seen; 1: x is in n crowded groups; 2: x needs n.
_GROUPED = "kind int, x bigint, y bigint, n bigint"


def _grouped(table: pa.Table) -> pa.Table:
    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    labels, needed, counts = joined("owners", np.uint64), joined("needed", np.int32), joined("counts", np.uint32)
    owner = np.repeat(labels, counts)
    sign = joined("ends", np.uint8).astype(np.uint64)
    sign <<= np.uint64(32)
    sign |= joined("signs", np.uint32)
    order = np.lexsort((owner, sign))
    sign = sign[order]
    owner = owner[order]
    del order
    again = np.concatenate([[False], (sign[1:] == sign[:-1]) & (owner[1:] == owner[:-1])])[: len(sign)]
    sign, owner = sign[~again], owner[~again]
    starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
    counts = np.diff(np.append(starts, len(sign)))
    # Sets above the band do not pair with each other here, so the group's first is one of the band.
    lower = (owner & np.uint64(1)) == 0
    several = np.repeat((counts > 1) & np.logical_or.reduceat(lower, starts), counts)
    sign, owner, lower = sign[several], owner[several], lower[several]
    if len(sign):
        order = np.lexsort((owner, ~lower, sign))
        sign, owner, lower = sign[order], owner[order], lower[order]
        starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
        counts = np.diff(np.append(starts, len(sign)))
    else:
        starts = counts = np.zeros(0, np.int64)
    rank = np.arange(len(sign)) - np.repeat(starts, counts)
    size, first = np.repeat(counts, counts), np.repeat(starts, counts)
    pairs = [np.stack([owner[first[rank > 0]], owner[rank > 0]])]
    for back in range(1, CROWD - 1):  # pairs of small groups without the first
        at = np.flatnonzero((rank > back) & (size <= CROWD))
        at = at[lower[at - back]]
        pairs.append(np.stack([owner[at - back], owner[at]]))
    pair = np.sort(np.concatenate(pairs, axis=1).view(np.int64), axis=0)
    order = np.lexsort((pair[1], pair[0]))
    pair = pair[:, order]
    fresh = np.flatnonzero(np.concatenate([[True], (pair[:, 1:] != pair[:, :-1]).any(0)])) if pair.shape[1] else np.zeros(0, np.int64)
    seen = np.diff(np.append(fresh, pair.shape[1]))
    crowded, times = np.unique(owner[(size > CROWD) & (rank > 0)], return_counts=True)
    told = needed > -(2**31)
    x = np.concatenate([pair[0, fresh], crowded.view(np.int64), labels[told].view(np.int64)])
    return pa.table({
        "kind": pa.array(np.repeat([0, 1, 2], [len(fresh), len(crowded), int(told.sum())]).astype(np.int32)),
        "x": pa.array(x), "y": pa.array(np.concatenate([pair[1, fresh], x[len(fresh) :]])),
        "n": pa.array(np.concatenate([seen, times, needed[told]]).astype(np.int64)),
    })


# The join.


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents whose sets link, from their texts."""
    ids = written(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct())
    texts = as_bytes(semi(docs, ids, "doc_id"), "doc_id")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("p"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("p"), batch.column("q")):
                p, q = _distinct([p.as_py(), q.as_py()], cache)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both > 0 and 100 * both >= 75 * (len(p) + len(q) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q")
    return met.mapInArrow(run, "a bigint, b bigint")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` doc_id, n_shingles, component_id and n_verified.

    component_id is the smallest doc_id reachable by links, itself included. n_verified counts the links that were verified to
    find the components; it is no count of all links, as large groups are held together by their first set. Null and empty texts have no
    shingles and link with nothing. Rows with equal sets link whatever their ids; rows that repeat an id
    count as one document with all their sets. A row without an id is its own component, null. Other columns do not matter.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets = written_in_slices(shingle_sets(docs))
    # One document stands for all with its set.
    label = F.conv(F.hex(F.substring("set_key", 1, 8)), 16, -10).cast("bigint")
    firsts = written(
        sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n")
        ).select("doc_id", label.bitwiseAND(F.lit(-2)).alias("label"), "n", "set_key")
    )
    bounds = firsts.agg(F.max("n").alias("largest"), F.sum("n").alias("all")).first()
    if not bounds["all"]:
        return sets.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("n_verified"))
    bands = band_starts(bounds["largest"])
    plans = [Plan(a, b) for a, b in zip(bands, bands[1:])]
    buckets = max(12, bounds["all"] // BUCKET_SIGNATURES + 1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        yield from _signed((_distinct(texts, cache) for _, texts in slices(batches)), bands, plans, buckets)

    # Later copies of a set send nothing: a group of copies has the signatures of one document.
    of_first = firsts.select("doc_id")
    copies = written(
        sets.where("doc_id IS NOT NULL").select("doc_id").distinct().join(of_first, "doc_id", "left_anti")
    )
    signing = without(docs.where("doc_id IS NOT NULL"), copies, "doc_id")
    signed = as_bytes(signing).mapInArrow(sign, _SIGNED)
    grouped = written_in_slices(signed.groupBy("bucket").applyInArrow(_grouped, _GROUPED))
    crowded = grouped.where("kind = 1").groupBy("x").agg(F.sum("n").alias("crowded"))
    needed = grouped.where("kind = 2").groupBy("x").agg(F.min("n").alias("needed"))
    known = needed.join(crowded, "x", "left").select("x", "needed", F.coalesce("crowded", F.lit(0)).alias("crowded"))
    other = known.toDF("y", "needed_y", "crowded_y")
    pairs = grouped.where("kind = 0").groupBy("x", "y").agg(F.sum("n").alias("n"))
    candidates = (
        pairs.join(known, "x").join(other, "y")
        .where(F.col("n") + F.least("crowded", "crowded_y") >= F.greatest("needed", "needed_y"))
        .select(F.col("x").bitwiseAND(F.lit(-2)).alias("x"), F.col("y").bitwiseAND(F.lit(-2)).alias("y"))
    )
    links = written_in_slices(_verified(_documents(candidates, firsts), docs))
    unsure = known.where("crowded >= needed").select(F.col("x").bitwiseAND(F.lit(-2)).alias("label")).distinct()
    return _classes(sets, firsts, _hidden(docs, firsts, unsure, links))


def _documents(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Pairs of labels (x, y) as pairs of documents a < b."""
    named = firsts.select("label", "doc_id")
    met = pairs.join(named.toDF("x", "one"), "x").join(named.toDF("y", "two"), "y")
    return written(met.where("one <> two").select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct())


def _hidden(docs: DataFrame, firsts: DataFrame, unsure: DataFrame, links: DataFrame) -> DataFrame:
    """The links, and those between sets whose crowded or empty segments may have hidden them.

    Where many sets share a rare shingle, one of them is compared with the others first, as long as that finds links: what it ties together
    needs no pairs of its own. What is left apart is compared pair by pair, if place, size and bits allow a link.
    """
    left = written(firsts.join(unsure, "label", "left_semi"))
    if not left.take(1):
        return links
    found = components(links).withColumnRenamed("id", "doc_id")
    named = written(left.join(found, "doc_id", "left").select("doc_id", "label", "n", F.coalesce("component", "doc_id").alias("component")))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for _, texts in slices(batches):
            own = [s for s in _distinct(texts, cache) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([_label_of(s) for s in own], np.uint64).view(np.int64)),
                    pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64())),
                    pa.array([_bits(s) for s in own], pa.list_(pa.int64())),
                ],
                names=["label", "tokens", "bits"],
            )

    ids = written(named.select("doc_id").distinct())
    each = as_bytes(semi(docs, ids, "doc_id")).mapInArrow(tokens, "label bigint, tokens array<bigint>, bits array<bigint>")
    each = written_in_slices(each.join(named.select("label"), "label", "left_semi").dropDuplicates(["label"]))
    bits = each.select("label", "bits")

    def tied(rows: DataFrame) -> DataFrame:
        """The rows with the components that links with a chosen set leave; these links are kept."""
        nonlocal links
        at, turn = named.select("doc_id", "component").distinct(), 0
        while _pairs_left(rows) > PAIRS_A_ROW * rows.count():
            hubs = _documents(_hub_pairs(rows, bits, turn), firsts)
            more = written_in_slices(_verified(hubs, docs))
            if not more.take(1):
                break
            ends = more.join(at.toDF("a", "p"), "a").join(at.toDF("b", "q"), "b")
            now = written(components(ends.select(F.col("p").alias("a"), F.col("q").alias("b"))).toDF("component", "now"))
            links, turn, rows, at = links.unionByName(more), turn + 1, written(_renamed(rows, now)), written(_renamed(at, now))
        return rows

    tokens_of = each.select(F.explode("tokens").alias("token"), "label")
    pairs = _documents(_prefix_pairs(tokens_of, named, bits, tied), firsts)
    return links.unionByName(written_in_slices(_verified(pairs, docs)))


def _renamed(rows: DataFrame, now: DataFrame) -> DataFrame:
    now = rows.join(now, "component", "left").withColumn("component", F.coalesce("now", "component"))
    return now.select(*rows.columns)


def _bits(tokens: np.ndarray) -> np.ndarray:
    """How many shingles fall on each of ``BITS`` places, odd or even: sets differ in as many shingles as bits, at least."""
    at = (mixed(tokens ^ np.uint64(0x27D4EB2F165667C5)) % np.uint64(BITS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


# Sets of n and m shingles link when they share 3 (n + m) / 7 of them, or differ in (n + m) / 7 at most.


def _reach(n: str, place: str, m: str) -> str:
    """Whether a set whose first ``place`` shingles are not in the other one can share enough."""
    return f"7 * ({n} - {place}) >= 3 * ({n} + {m})"


_ALIKE = "7 * aggregate(zip_with(bits, other_bits, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c) <= n + m"


def _prefix_rows(each: DataFrame, named: DataFrame) -> DataFrame:
    """label, n, component, token and place of every set's rarest shingles.

    Linked sets share at least 3/4 of the larger, so in any one order of all shingles each has a common one among its first
    s - ceil(3 s / 4) + 1. The order is by the number of sets, so what many components share comes last. Shingles of one set are left out.
    """
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
    first = "slice(all, 1, size(all) - CAST(ceil(size(all) * 3 / 4) AS INT) + 1)"
    ranked = (
        each.join(often, "token").groupBy("label")
        .agg(F.array_sort(F.collect_set(F.struct("sets", "token"))).alias("all"))
        .select("label", F.posexplode(F.expr(first)).alias("place", "at"))
        .where("at.sets > 1").select("label", "place", "at.token")
        .join(named.select("label", "n", "component"), "label")
    )
    return written(ranked)


def _able(rows: DataFrame) -> DataFrame:
    """Rows whose shingle is not too late in its set for the smallest set that has it."""
    smallest = rows.groupBy("token").agg(F.min("n").alias("least"))
    return written(rows.join(smallest, "token").where(_reach("n", "place", "least")).drop("least"))


def _mixed(rows: DataFrame, *more: Column) -> DataFrame:
    """The shingles whose sets are in several components; the others have no pairs left."""
    return rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), *more).where("low <> high").drop("low", "high")


def _pairs_left(rows: DataFrame) -> float:
    counted = _mixed(rows, F.count(F.lit(1)).cast("double").alias("sets"))
    return counted.agg(F.sum(F.col("sets") * F.col("sets"))).first()[0] or 0.0


def _hub_pairs(rows: DataFrame, bits: DataFrame, turn: int) -> DataFrame:
    """Pairs (x, y) of a set and the one chosen under a shingle: first the set with the smallest part of rarer shingles, later any."""
    rank = F.struct(F.col("place") / F.col("n"), "label") if turn == 0 else F.struct(F.xxhash64("label", F.lit(turn)), "label")
    chosen = F.min_by(F.struct("label", "n", "place", "component"), rank).alias("hub")
    met = rows.join(_mixed(rows, chosen), "token").where(
        f"component <> hub.component AND {_reach('n', 'place', 'hub.n')} AND {_reach('hub.n', 'hub.place', 'n')}"
    )
    pairs = written(met.select(F.col("label").alias("x"), F.col("hub.label").alias("y"), "n", F.col("hub.n").alias("m")).distinct())
    with_bits = pairs.join(bits.withColumnRenamed("label", "x"), "x").join(bits.toDF("y", "other_bits"), "y")
    return with_bits.where(_ALIKE).select("x", "y")


def _prefix_pairs(
    each: DataFrame, named: DataFrame, bits: DataFrame | None = None, tied: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Pairs (x, y) of sets of different components that share one of their rarest shingles.

    With bits of the sets, only those that can link: the first shingle two sets share has a place in both from which enough is left, and
    their bits differ in few places. ``tied`` may put sets together before. Shingles whose sets are all in one component have no pairs left.
    """
    rows, may_link = _prefix_rows(each, named), "component < other AND 4 * least(n, m) >= 3 * greatest(n, m)"
    if bits is not None:
        rows = _able(rows)
        may_link += f" AND {_reach('n', 'place', 'm')} AND {_reach('m', 'other_place', 'n')} AND {_ALIKE}"
    if tied:
        rows = tied(rows)
    left = rows.join(_mixed(rows), "token", "left_semi")
    left = written(left if bits is None else left.join(bits, "label"))
    other = left.select(
        "token", *[F.col(c).alias(d) for c, d in zip(("label", "n", "component", "place", "bits"), ("y", "m", "other", "other_place", "other_bits")) if c in left.columns]
    )
    return left.withColumnRenamed("label", "x").join(other, "token").where(may_link).select("x", "y").distinct()


def _classes(sets: DataFrame, firsts: DataFrame, links: DataFrame) -> DataFrame:
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    links = written(links)
    both = links.select("a").unionByName(links.select(F.col("b").alias("a")))
    degrees = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_verified")).withColumnRenamed("a", "doc_id")
    # Rows that repeat an id may have several sets: they tie those together.
    ties = sets.where("n_shingles > 0").join(firsts.select("set_key", F.col("doc_id").alias("first")), "set_key")
    ties = written(ties.select("doc_id", "first").distinct())
    found = components(links.unionByName(ties.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))))
    return (
        sets.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .join(degrees, "doc_id", "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce("n_verified", F.lit(0)).cast("bigint").alias("n_verified"),
        )
    )
