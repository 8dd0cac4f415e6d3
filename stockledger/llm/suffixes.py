"""Exact substring deduplication by sorted suffix runs, merged without comparing known prefixes.

Every string of ``LENGTH`` bytes has, among its first ``LENGTH - GRAM`` + 1 starts, one whose gram
(``GRAM`` bytes) has the smallest hash. Equal strings have it at the same place, so only suffixes
that begin at such anchors need sorting, and of these only those whose gram occurs in two documents.

1. Anchors' hashes are exchanged in bucketed blobs, one for all that a slice of documents shares; those in one document only drop out.
2. The remaining anchors' suffixes are sorted within each slice of documents, equal ones folded, and
   exchanged as front-coded runs, cut at splitters taken from a sample of their grams.
3. Runs are merged by a loser tree that carries each run's common prefix with the last output
   and compares only what lies behind it. The common prefixes of neighbours fall out of the merge, and
   with them, for every offset, which strings are equal and the smallest document that holds them.
4. Documents after the smallest learn their intervals and cut them out.

Copies of a whole text are folded before and answered by the first of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.shared import BROADCAST_ROWS, as_bytes, mixed, place_bound, slices, written

LENGTH, GRAM = 50, 25
STARTS = LENGTH - GRAM + 1

# Anchors one reducer looks at, and suffixes one merge puts out.
BUCKET_ANCHORS, RANGE_SUFFIXES = 1_000_000, 150_000

# A suffix that more documents of one slice share keeps them at home and meets its answer in a join.
FOLDED = 16

# Bytes of answers to folded suffixes that are broadcast at most; more are joined by a shuffle.
ANSWER_BYTES = 16 * 1024 * 1024

# Bytes whose grams are hashed at once.
PIECE = 256 * 1024

_FACTOR = 0x9E3779B97F4A7C15


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_FACTOR, k, 2**64))


_BYTES = np.random.default_rng(3).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all grams of a byte array, put together from those of 1, 2, 4, 8 and 16 bytes."""
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, done, width, out = _BYTES[codes], 0, 1, None
    while True:
        if GRAM & width:
            piece = part[done : done + n] * _power(done)
            out, done = piece if out is None else out + piece, done + width
        if width * 2 > GRAM:
            return mixed(out)
        part = part[:-width] + _power(width) * part[width:]
        width *= 2


def _slid(values: np.ndarray, width: int, choose) -> np.ndarray:
    """The smallest or largest of every ``width`` neighbours."""
    n, k, out = len(values) - width + 1, 1, values
    while k * 2 <= width:
        out, k = choose(out[:-k], out[k:]), k * 2
    return choose(out[:n], out[width - k : width - k + n])


def anchors(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the grams that are smallest in some string inside one document; ``ends`` of the documents."""
    if len(hashes) < STARTS:
        return np.zeros(0, np.int64)
    lowest = _slid(hashes, STARTS, np.minimum)
    starts = np.arange(len(lowest))
    lowest[ends[np.searchsorted(ends, starts, side="right")] < starts + LENGTH] = 0
    around = np.zeros(STARTS - 1, np.uint64)
    return np.flatnonzero(_slid(np.concatenate([around, lowest, around]), STARTS, np.maximum) == hashes)


def _anchored(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a slice, ends of its documents, and places and hashes of its anchors.

    Hashes take many times the room of the bytes, so they are made for ``PIECE`` bytes at a time, with as
    many to either side as an anchor depends on.
    """
    codes = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at in range(0, len(codes), PIECE):
        low = max(0, at - STARTS + 1)
        hashes = gram_hashes(codes[low : at + PIECE + LENGTH])
        own = anchors(hashes, ends - low)
        own = own[(own >= at - low) & (own < at - low + PIECE)]
        places.append(own + low)
        found.append(hashes[own])
    return codes, ends, np.concatenate(places), np.concatenate(found)


def _blob(values: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def _runs_of(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


# Step 1: anchors that occur in two documents.


# Ordinal of an anchor that stands for those its slice has in two documents already.
_KNOWN = 2**32 - 1


def _offered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Anchors by bucket of their hash; in bucket -1 - n, those of documents of target bucket n that two documents of a slice have."""
    for part, texts in slices(batches):
        _, ends, places, hashes = _anchored(texts)
        if not len(places):
            continue
        doc = np.searchsorted(ends, places, side="right")
        ordinal = np.arange(len(places)) - np.searchsorted(doc, doc)  # the how-manieth anchor of its document
        ids = np.array(part.column("doc_id").to_pylist(), np.int64)[doc]
        order = np.lexsort((ids, hashes))
        starts = _runs_of(hashes[order])
        sizes = np.diff(np.append(starts, len(order)))
        several = ids[order[starts]] != ids[order[starts + sizes - 1]]
        here, alone = order[np.repeat(several, sizes)], order[np.repeat(~several, sizes)]
        stands = order[starts[several]]
        target = -1 - (mixed(ids[here].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        sent = np.concatenate([alone, stands])
        # Anchors are small hashes, so they are mixed once more to fall evenly.
        bucket = ((mixed(hashes[sent]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        number = np.concatenate([ordinal[alone], np.full(len(stands), _KNOWN), ordinal[here]])
        at, bucket = np.concatenate([sent, here]), np.concatenate([bucket, target])
        again = np.lexsort((ids[at], bucket))
        at, bucket, number = at[again], bucket[again], number[again]
        bounds = np.append(_runs_of(bucket), len(at))
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = ids[at[a:b]]
            firsts = _runs_of(own)
            out.append((
                int(bucket[a]), _blob(own[firsts], np.int64), _blob(np.diff(np.append(firsts, b - a)), np.uint32),
                _blob(hashes[at[a:b]], np.uint32) if bucket[a] >= 0 else b"", _blob(number[a:b], np.uint32),
            ))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], pa.int64() if i == 0 else pa.binary()) for i in range(5)],
            names=["bucket", "docs", "counts", "hashes", "ordinals"],
        )


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared(table: pa.Table, targets: int) -> pa.Table:
    """Anchors of this bucket that two documents have, by document in one row for each target bucket."""
    if table.column("bucket")[0].as_py() < 0:
        targets_of = pa.array([-1 - b for b in table.column("bucket").to_pylist()], pa.int64())
        return pa.table({"target": targets_of} | {n: table.column(n) for n in ("docs", "counts", "ordinals")})
    doc = np.repeat(_joined(table, "docs", np.int64), _joined(table, "counts", np.uint32))
    hashes, ordinals = _joined(table, "hashes", np.uint32), _joined(table, "ordinals", np.uint32)
    order = np.lexsort((doc, hashes))
    starts = _runs_of(hashes[order])
    sizes = np.diff(np.append(starts, len(order)))
    several = doc[order[starts]] != doc[order[starts + sizes - 1]]
    if len(starts):
        several |= np.logical_or.reduceat(ordinals[order] == _KNOWN, starts)
    kept = order[np.repeat(several, sizes)]
    kept = kept[ordinals[kept] != _KNOWN]
    target = (mixed(doc[kept].view(np.uint64)) % np.uint64(targets)).astype(np.int64)
    again = np.lexsort((doc[kept], target))
    kept, target = kept[again], target[again]
    bounds = np.append(_runs_of(target), len(kept))
    rows = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = doc[kept[a:b]]
        firsts = _runs_of(own)
        rows.append((
            int(target[a]), own[firsts].tobytes(), _blob(np.diff(np.append(firsts, b - a)), np.uint32),
            _blob(ordinals[kept[a:b]], np.uint32),
        ))
    names = ["target", "docs", "counts", "ordinals"]
    return pa.table({n: pa.array([r[i] for r in rows], pa.binary() if i else pa.int64()) for i, n in enumerate(names)})


def _by_document(table: pa.Table) -> pa.Table:
    """The ordinals of every document of a target bucket, from all buckets of hashes."""
    doc = np.repeat(_joined(table, "docs", np.int64), _joined(table, "counts", np.uint32))
    ordinals = _joined(table, "ordinals", np.uint32)
    order = np.argsort(doc, kind="stable")
    doc, ordinals = doc[order], ordinals[order]
    firsts = _runs_of(doc)
    ends = np.append(firsts, len(doc))
    return pa.table({
        "doc_id": pa.array(doc[firsts]),
        "ordinals": pa.array([ordinals[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
    })


# Step 2: sorted runs.


def _words_of(codes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes from the given starts, as a matrix."""
    return codes[starts[:, None] + np.arange(width)]


def _keys(matrix: np.ndarray) -> list[np.ndarray]:
    """A byte matrix as columns of big-endian integers, the first most significant."""
    width = -(-matrix.shape[1] // 8) * 8
    padded = np.zeros((len(matrix), width), np.uint8)
    padded[:, : matrix.shape[1]] = matrix
    return list(padded.view(">u8").astype(np.uint64).T)


def _grams_of(matrix: np.ndarray) -> np.ndarray:
    """The first gram of every row of bytes, to be compared; suffixes of one gram have to stay in one range."""
    return np.ascontiguousarray(matrix[:, :GRAM]).view(f"S{GRAM}").ravel()


def _front_coded(matrix: np.ndarray) -> tuple[np.ndarray, bytes]:
    """How many bytes each row shares with the row before it, and the rest of each row."""
    same = matrix[1:] == matrix[:-1]
    shared = np.concatenate([[0], np.where(same.all(1), matrix.shape[1], same.argmin(1))]).astype(np.uint8)
    return shared, matrix[np.arange(matrix.shape[1]) >= shared[:, None]].tobytes()


def _rows_back(shared: np.ndarray, rest: bytes) -> Iterator[bytes]:
    """The rows of a front-coded run in turn."""
    at, row = 0, b""
    for k in shared.tolist():
        row = row[:k] + rest[at : at + LENGTH - k]
        at += LENGTH - k
        yield row


# A run of a range from 0; below 0, members of one folded suffix, which only pass through.
_RUN = (
    "range int, shared binary, rest binary, left binary, lengths binary, lowest binary, members binary, "
    "docs binary, places binary, folded binary"
)


def _sorted_runs(batches: Iterator[pa.RecordBatch], splitters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One run for every slice and range: distinct suffixes in order with what stands before them."""
    reach = LENGTH - GRAM
    for part, texts in slices(batches):
        codes, ends, places, _ = _anchored(texts)
        if not len(places):
            continue
        doc = np.searchsorted(ends, places, side="right")
        first = np.searchsorted(doc, np.arange(len(texts)))
        wanted = [np.frombuffer(x.as_buffer(), np.uint32) for x in part.column("ordinals")]
        at = np.concatenate([f + np.unique(w) for f, w in zip(first, wanted)]).astype(np.int64)
        at = at[at < len(places)]
        at = np.unique(at)
        places, doc = places[at], doc[at]
        if not len(places):
            continue
        begins = np.concatenate([[0], ends[:-1]])
        before = np.minimum(places - begins[doc], reach).astype(np.uint8)
        behind = np.minimum(ends[doc] - places, LENGTH).astype(np.uint8)
        framed = np.concatenate([np.zeros(reach, np.uint8), codes, np.zeros(LENGTH, np.uint8)])
        right = _words_of(framed, places + reach, LENGTH) * (np.arange(LENGTH) < behind[:, None])
        left = _words_of(framed, places, reach)[:, ::-1] * (np.arange(reach) < before[:, None])  # nearest byte first
        keys = [*_keys(right), *_keys(left), behind.astype(np.uint64) << np.uint64(8) | before]
        order = np.lexsort(keys[::-1])
        ranked = [k[order] for k in keys]
        fresh = np.zeros(len(order), bool)
        fresh[0] = True
        for k in ranked:
            fresh[1:] |= k[1:] != k[:-1]
        entry = np.cumsum(fresh) - 1
        head = order[fresh]
        ids = np.array(part.column("doc_id").to_pylist(), np.int64)[doc]
        moved = places - begins[doc] + np.array(part.column("offset").to_pylist(), np.int64)[doc]
        lowest = np.minimum.reduceat(ids[order], np.flatnonzero(fresh))
        sizes = np.bincount(entry)
        context = mixed(mixed(sum((mixed(k[head] + np.uint64(i)) * _power(i + 1) for i, k in enumerate(keys)), np.uint64(0))))
        ranges = np.searchsorted(splitters, _grams_of(right[head]), side="right")
        bounds = np.append(_runs_of(ranges), len(head))
        offsets = np.append(np.flatnonzero(fresh), len(order))
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            shared, rest = _front_coded(right[head[a:b]])
            own, many = order[offsets[a] : offsets[b]], sizes[a:b] > FOLDED
            here = own[~np.repeat(many, sizes[a:b])]
            out.append((
                int(ranges[a]), shared.tobytes(), rest, left[head[a:b]].tobytes(),
                _blob(behind[head[a:b]].astype(np.uint16) << 8 | before[head[a:b]], np.uint16), _blob(lowest[a:b], np.int64),
                _blob(np.where(many, 0, sizes[a:b]), np.uint32), _blob(ids[here], np.int64), _blob(moved[here], np.int64),
                _blob(np.where(many, context[a:b], 0), np.uint64),
            ))
        for i in np.flatnonzero(sizes > FOLDED).tolist():
            own, name = order[offsets[i] : offsets[i + 1]], context[i : i + 1]
            aside = -1 - int((int(name[0]) + int(ids[own[0]])) % (len(splitters) + 1))
            out.append((aside, b"", b"", b"", b"", b"", b"", _blob(ids[own], np.int64), _blob(moved[own], np.int64), name.tobytes()))
        names = [x.split()[0] for x in _RUN.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], pa.int32() if i == 0 else pa.binary()) for i in range(len(names))], names=names
        )


# Step 3: the merge.


class LoserTree:
    """Merges sorted runs of rows of ``LENGTH`` bytes; each run knows the prefix it shares with the last output.

    Of two heads, the one sharing more with the last output is smaller. Only if both share the same are
    they compared, behind that prefix, and the loser then shares with the winner what the comparison found.
    """

    def __init__(self, runs: list[tuple[np.ndarray, bytes]]):
        self.heads = [_rows_back(*run) for run in runs]
        self.shares = [iter(run[0].tolist()) for run in runs]
        self.row: list[bytes | None] = [None] * len(runs)
        self.known = [0] * len(runs)
        for i in range(len(runs)):
            self._next(i)
        self.size = len(runs)
        self.losers = [-1] * self.size
        for i in range(self.size):
            self._replay(i, True)

    def _next(self, i: int) -> None:
        self.row[i] = next(self.heads[i], None)
        # The run's last head was the last output: its front code is what the next one shares with it.
        self.known[i] = next(self.shares[i], -1)

    def _beats(self, a: int, b: int) -> bool:
        """Whether head a goes before head b; the loser's known prefix is then with the winner."""
        x, y = self.row[a], self.row[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        k = self.known[a]
        if k != self.known[b]:
            return k > self.known[b]  # the loser shares no more with the winner than with the last output
        x, y = int.from_bytes(x[k:], "big"), int.from_bytes(y[k:], "big")
        apart = x ^ y
        shared = LENGTH - ((apart.bit_length() + 7) >> 3)
        wins = x < y or (not apart and a < b)
        self.known[b if wins else a] = shared
        return wins

    def _replay(self, i: int, filling: bool = False) -> None:
        winner, node = i, (i + self.size) >> 1
        while node:
            other = self.losers[node]
            if other < 0:
                if filling:
                    self.losers[node] = winner
                    return
            elif not self._beats(winner, other):
                self.losers[node], winner = winner, other
            node >>= 1
        self.top = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, bytes shared with the output before) of every row in order."""
        if self.size == 1:
            self.top = 0
        while self.row[self.top] is not None:
            i = self.top
            yield i, self.known[i]
            self._next(i)
            self._replay(i)


def _classes_at(shared: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the groups of neighbours that share at least ``depth`` bytes."""
    return np.cumsum(shared < depth)


# kind 0: bytes that documents of a target bucket lose, the starts and ends of ``counts`` intervals each; 1: smallest documents of
# a folded suffix; 2: members of one.
_FOUND = "kind int, id bigint, docs binary, counts binary, a binary, b binary"


def _found_rows(rows: list[tuple]) -> dict[str, pa.Array]:
    names = [x.split()[0] for x in _FOUND.split(", ")]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))}


def _merged(table: pa.Table, targets: int) -> pa.Table:
    """The runs of one range merged, and what follows for their members."""
    if table.column("range")[0].as_py() < 0:
        names = [int(np.frombuffer(x, np.int64)[0]) for x in table.column("folded").to_pylist()]
        members = zip(names, table.column("docs").to_pylist(), table.column("places").to_pylist())
        return pa.table(_found_rows([(2, name, b"", b"", docs, places) for name, docs, places in members]))
    columns = {name: table.column(name).to_pylist() for name in table.column_names if name != "range"}

    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(columns[name]), kind)

    runs = [(np.frombuffer(s, np.uint8), r) for s, r in zip(columns["shared"], columns["rest"])]
    lengths = [len(r[0]) for r in runs]
    total = sum(lengths)
    merged = np.fromiter((x for pair in LoserTree(runs) for x in pair), np.int64, 2 * total).reshape(total, 2)
    # Rows of a run come out in its order, so the merge is a permutation of all entries.
    order, shared = np.argsort(np.argsort(merged[:, 0], kind="stable"), kind="stable"), merged[:, 1]
    left = joined("left", np.uint8).reshape(total, LENGTH - GRAM)[order]
    sizes = joined("lengths", np.uint16)[order]
    behind, before = (sizes >> 8).astype(np.int64), (sizes & 255).astype(np.int64)
    lowest = joined("lowest", np.int64)[order]
    by_left = np.lexsort(_keys(left)[::-1])
    same = left[by_left[1:]] == left[by_left[:-1]]
    left_shared = np.concatenate([[0], np.where(same.all(1), LENGTH - GRAM, same.argmin(1))])
    none = np.iinfo(np.int64).max
    smallest = np.full((STARTS, total), none)
    for j in range(STARTS):
        valid = np.flatnonzero((before >= j) & (behind >= LENGTH - j))
        if not len(valid):
            continue
        left_class = np.empty(total, np.int64)
        left_class[by_left] = _classes_at(left_shared, j)
        key = _classes_at(shared, LENGTH - j)[valid] * (total + 1) + left_class[valid]
        ranked = np.argsort(key, kind="stable")
        starts = _runs_of(key[ranked])
        least = np.minimum.reduceat(lowest[valid[ranked]], starts)
        smallest[j, valid[ranked]] = np.repeat(least, np.diff(np.append(starts, len(ranked))))
    # Back to the order of the runs, and from entries to their members.
    back = np.argsort(order)
    smallest = smallest[:, back]
    folded, members = joined("folded", np.uint64), joined("members", np.uint32)
    entry = np.repeat(np.arange(total), members)
    ids, places = joined("docs", np.int64), joined("places", np.int64)
    keys = np.flatnonzero(folded != 0)
    out = [(1, int(folded[k : k + 1].view(np.int64)[0]), b"", b"", smallest[:, k].tobytes(), b"") for k in keys]
    for at in range(0, len(ids), RANGE_SUFFIXES):
        piece = slice(at, at + RANGE_SUFFIXES)
        out += _intervals(ids[piece], places[piece], smallest[:, entry[piece]], targets)
    return pa.table(_found_rows(out))


def _intervals(ids: np.ndarray, places: np.ndarray, smallest: np.ndarray, targets: int) -> list[tuple]:
    """What smaller documents hold, in one row for each target bucket of documents; ``smallest`` by offset and member."""
    offset, member = np.nonzero(smallest < ids)
    starts, ids = places[member] - offset, ids[member]
    target = (mixed(ids.view(np.uint64)) % np.uint64(targets)).astype(np.int64)
    order = np.lexsort((starts, ids, target))
    starts, ids, target = starts[order], ids[order], target[order]
    # Strings that overlap or touch are one interval: most members lose all of theirs.
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + LENGTH)
    at = np.flatnonzero(fresh)
    ends = starts[np.append(at[1:], len(starts)) - 1] + LENGTH if len(at) else at
    starts, ids, target = starts[at], ids[at], target[at]
    bounds = np.append(_runs_of(target), len(at))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        firsts = _runs_of(ids[a:b])
        counts = np.diff(np.append(firsts, b - a))
        out.append((
            0, int(target[a]), ids[a:b][firsts].tobytes(), _blob(counts, np.uint32), _blob(starts[a:b], np.int64), _blob(ends[a:b], np.int64),
        ))
    return out


def _of_documents(table: pa.Table) -> pa.Table:
    """All intervals of every document of a target bucket."""
    doc = np.repeat(_joined(table, "docs", np.int64), _joined(table, "counts", np.uint32))
    starts, ends = _joined(table, "a", np.int64), _joined(table, "b", np.int64)
    order = np.argsort(doc, kind="stable")
    doc, starts, ends = doc[order], starts[order], ends[order]
    bounds = np.append(_runs_of(doc), len(doc))
    spans = list(zip(bounds[:-1], bounds[1:]))
    return pa.table({
        "doc_id": pa.array(doc[bounds[:-1]]),
        "starts": pa.array([starts[a:b].tobytes() for a, b in spans], pa.binary()),
        "ends": pa.array([ends[a:b].tobytes() for a, b in spans], pa.binary()),
    })


def _answered(batches: Iterator[pa.RecordBatch], targets: int) -> Iterator[pa.RecordBatch]:
    """Intervals of the members of folded suffixes, from the answer to their suffix."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, places = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["places"], np.int64)
            smallest = np.repeat(np.frombuffer(row["answer"], np.int64)[:, None], len(ids), axis=1)
            yield pa.RecordBatch.from_pydict(_found_rows(_intervals(ids, places, smallest, targets)))


# Step 4: cutting.


def cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    edges = np.zeros(len(text) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    gone = np.cumsum(edges[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()


_DOC = "doc_id bigint, uid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            size, offset = len(row["text"]), row["offset"]
            starts, ends = (np.frombuffer(row[c], np.int64) - offset for c in ("starts", "ends"))
            own = (ends > 0) & (starts < size)  # the others are of other texts with this id
            n, runs, kept = cut(row["text"], np.clip(starts[own], 0, size), np.clip(ends[own], 0, size))
            rows.append((row["doc_id"], row["uid"], n, runs, hashlib.sha256(kept).hexdigest(), kept))
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = [x.split()[0] for x in _DOC.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def substring_dedup(docs: DataFrame, keep_texts: bool = False) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans, kept_sha256; ``kept`` (bytes) on request.

    A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller doc_id. Null and
    empty texts, and those of fewer bytes, lose nothing. Rows of one id never cut each other; repeated rows give
    repeated rows. Other columns do not matter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64(text).alias("uid"))
    rows = written(own.select("doc_id", "uid", F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("key")))
    firsts = written(
        rows.where(F.col("n_bytes") >= LENGTH).groupBy("key", "n_bytes").agg(
            F.min("doc_id").alias("first"), F.min("uid").alias("uid")
        )
    )
    # Texts of one id lie one behind the other in its numbering of places.
    earlier = Window.partitionBy("first").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    leading = written(
        firsts.where(F.col("first").isNotNull()).select(
            F.col("first").alias("doc_id"), "uid", F.coalesce(F.sum("n_bytes").over(earlier), F.lit(0)).alias("offset")
        )
    )
    totals = firsts.agg(F.sum("n_bytes").alias("n"), F.count(F.lit(1)).alias("texts")).first()
    few = totals["texts"] <= BROADCAST_ROWS
    texts = own.join(F.broadcast(leading) if few else leading, ["doc_id", "uid"])

    anchors_in_all = 2 * (totals["n"] or 0) // (STARTS + 1)
    buckets = max(12, anchors_in_all // BUCKET_ANCHORS + 1)
    offered = as_bytes(texts, "doc_id").mapInArrow(
        lambda batches: _offered(batches, buckets), "bucket bigint, docs binary, counts binary, hashes binary, ordinals binary"
    )
    shared = written(
        offered.groupBy("bucket").applyInArrow(
            lambda table: _shared(table, buckets), "target bigint, docs binary, counts binary, ordinals binary"
        )
    )
    suffixes = (shared.agg(F.sum(F.octet_length("ordinals")).alias("n")).first()["n"] or 0) // 4
    marked = written(shared.groupBy("target").applyInArrow(_by_document, "doc_id bigint, ordinals binary"))
    splitters = _splitters(texts, marked, suffixes // RANGE_SUFFIXES + 1)
    # In one order, so that a task that is run again cuts its texts into the same slices.
    met = as_bytes(texts, "doc_id", "offset").join(marked, "doc_id").sortWithinPartitions("doc_id", "offset")
    runs = met.mapInArrow(lambda batches: _sorted_runs(batches, splitters), _RUN)
    found = written(runs.groupBy("range").applyInArrow(lambda table: _merged(table, buckets), _FOUND))
    # The same folded suffix comes from many runs and has one answer for all.
    answers = written(found.where("kind = 1").select("id", F.col("a").alias("answer")).dropDuplicates(["id"]))
    # A suffix that very many documents share is one id; where answers are few its members stay where they are.
    at_hand = answers.count() * 8 * (STARTS + 1) <= ANSWER_BYTES
    members = found.where("kind = 2").select("id", F.col("a").alias("docs"), F.col("b").alias("places"))
    answered = members.join(F.broadcast(answers) if at_hand else answers, "id").mapInArrow(lambda batches: _answered(batches, buckets), _FOUND)
    intervals = (
        found.where("kind = 0").unionByName(answered).groupBy("id")
        .applyInArrow(_of_documents, "doc_id bigint, starts binary, ends binary")
    )
    done = as_bytes(texts, "doc_id", "uid", "offset").join(intervals, "doc_id").mapInArrow(_cut_out, _DOC)
    if not keep_texts:
        done = done.drop("kept")
    return _answers(rows, firsts, written(done).dropDuplicates(["doc_id", "uid"]), keep_texts, own)


SAMPLED_TEXTS, SAMPLED_ANCHORS = 2_000, 200


def _splitters(texts: DataFrame, marked: DataFrame, n: int) -> np.ndarray:
    """Cuts of the order of suffixes, by their grams, from a bounded sample of the documents whose suffixes are sorted.

    The sample decides only how even the ranges are, nothing about results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            codes, ends, places, _ = _anchored(texts)
            doc = np.searchsorted(ends, places, side="right")
            first = np.searchsorted(doc, np.arange(len(texts)))
            out = []
            for f, wanted in zip(first, part.column("ordinals").to_pylist()):
                at = f + np.unique(np.frombuffer(wanted, np.uint32)).astype(np.int64)
                at = at[at < len(places)]
                out.append(places[at[:: max(1, len(at) // SAMPLED_ANCHORS)]])
            framed = np.concatenate([codes, np.zeros(GRAM, np.uint8)])
            grams = _words_of(framed, np.concatenate(out), GRAM) if out else np.zeros((0, GRAM), np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(grams).tobytes()], pa.binary())], names=["grams"])

    place = F.xxhash64("doc_id")
    bound = place_bound(marked.select(place.alias("place")), SAMPLED_TEXTS)
    few = marked.where(place <= bound)  # twice SAMPLED_TEXTS at most
    sample = as_bytes(texts, "doc_id").join(F.broadcast(few), "doc_id").mapInArrow(run, "grams binary").collect()
    grams = np.sort(np.frombuffer(b"".join(bytes(r["grams"]) for r in sample), f"S{GRAM}"))
    return np.unique(grams[np.arange(1, n) * len(grams) // n]) if len(grams) else grams


def _answers(rows: DataFrame, firsts: DataFrame, done: DataFrame, keep_texts: bool, own: DataFrame) -> DataFrame:
    """Every row's answer: cut, left as it is, or gone because a smaller id has the whole text."""
    judged = rows.join(firsts.select("key", "first"), "key", "left").join(done, ["doc_id", "uid"], "left")
    copy = F.col("first") < F.col("doc_id")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    out = judged.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", "key")).alias("kept_sha256"),
        *([F.when(copy, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"), "uid"] if keep_texts else []),
    )
    if not keep_texts:
        return out
    texts = as_bytes(own, "doc_id", "uid").dropDuplicates(["doc_id", "uid"])
    return out.join(texts, ["doc_id", "uid"], "left").withColumn("kept", F.coalesce("kept", "text")).drop("uid", "text")
