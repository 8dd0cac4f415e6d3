"""Quality rules: word and repetition counts, and lines that many documents of a host share.

Lines are normalised and hashed, and the distinct documents of a host that hold a line are
counted; exact copies of a text count as one document, so a copied text is left to
deduplication. Lines above a limit are removed, and a document that loses too large a
share of its words with them is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.shared import BROADCAST_ROWS, WordHashes, as_bytes, mixed, slices, word_hashes, written, written_in_slices

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# A line is boilerplate in a host if at least so many documents, and so large a share of
# the host's documents, hold it; a document is depleted if it keeps a smaller share of its words.
# The SQL twin states these limits. A share of 0 leaves the number alone, which does not grow with the host.
MIN_DOCUMENTS = 50
MIN_SHARE = 0.0
MIN_KEPT_SHARE = 0.5

# Rows with one line of one host are dealt over so many keys of the join with removed lines.
SALTS = 16

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True

_COUNTED = (
    "host string, doc_id bigint, text_key bigint, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line: bigint, words: bigint>>"
)


def _repeated(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per document, the words in windows of three words that its text holds twice or more."""
    n, docs = len(hashes), len(starts) - 1
    owner = np.repeat(np.arange(docs), np.diff(starts))
    covered = np.zeros(n + 3, np.int64)
    if n >= 3:
        inside = owner[: n - 2] == owner[2:]
        at = np.flatnonzero(inside)
        key = mixed(hashes[at] * np.uint64(3) + mixed(hashes[at + 1] * np.uint64(5) + mixed(hashes[at + 2])))
        key = mixed(key + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = at[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        np.add.at(covered, twice, 1)
        covered = np.maximum(covered, np.maximum(np.roll(covered, 1), np.roll(covered, 2)))
    sums = np.concatenate([[0], np.cumsum(covered[:n] > 0)])
    return sums[starts[1:]] - sums[starts[:-1]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    lines_type = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
    for part, texts in slices(batches):
        hashes, starts = word_hashes([t.split() for t in texts], cache)
        repeated = _repeated(hashes, starts)
        chars, symbols, copies, kept = [], [], [], []
        for text in texts:
            codes = np.frombuffer(text, np.uint8)
            chars.append(int((((codes & 0xC0) != 0x80) & ~_SPACES[codes]).sum()))
            symbols.append(int(_SYMBOLS[codes].sum()))
            held = [line for line in text.split(b"\n") if line.strip()]
            copies.append(len(held) - len(set(held)))
            own: dict[int, int] = {}
            for line in held:
                words = line.lower().split()
                line_key = xxhash.xxh64_intdigest(b" ".join(words), seed=42)  # as _line_key has it
                line_key -= 2**64 if line_key >= 2**63 else 0
                own[line_key] = own.get(line_key, 0) + len(words)
            kept.append([{"line": k, "words": v} for k, v in own.items()])
        keys = np.array([xxhash.xxh64_intdigest(t, seed=42) for t in texts], np.uint64).view(np.int64)
        columns = [
            part.column("host"), part.column("doc_id"), pa.array(keys, pa.int64()),
            pa.array(np.diff(starts)), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()),
            pa.array(copies, pa.int64()), pa.array(repeated), pa.array(kept, lines_type),
        ]
        names = [x.split()[0] for x in _COUNTED.split(", lines")[0].split(", ")] + ["lines"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _line_key(line: Column) -> Column:
    """The key of a line: its words, A to Z lower-cased, with one space between."""
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.xxhash64(F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " ")))


def _host(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = MIN_SHARE,
    min_kept_share: float = MIN_KEPT_SHARE,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, host): its counts, base_failed, kept, n_removed_words, text_key.

    A null text has no words and fails; a null host is a host of its own. Rows with equal
    text are one document in the counts of lines; every row is judged by itself and repeated
    rows give repeated rows. An empty table gives an empty one. text_key is xxhash64 of the text (null: empty). Other
    columns do not matter.
    """
    return _judged(docs, host, min_documents, min_share, min_kept_share).drop("host", "removed")


def cleaned(
    docs: DataFrame,
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = MIN_SHARE,
    min_kept_share: float = MIN_KEPT_SHARE,
) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, all columns, texts without their removed lines.

    The other lines of a text stay as they are, blank ones too; a column n_chars follows a text that has changed.
    """
    judged = _judged(docs, host, min_documents, min_share, min_kept_share)
    keys = ["doc_id", "host", "text_key"]
    # Of rows that go, nothing need be known of their lines.
    lost = F.when(F.col("kept"), F.col("removed")).otherwise(F.array().cast("array<bigint>")).alias("removed")
    edits = written(judged.where("NOT kept OR n_removed_words > 0").select(*keys, "kept", lost).distinct())
    few = (edits.agg(F.sum(F.size("removed") + 1)).first()[0] or 0) <= BROADCAST_ROWS // 4
    keyed = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), _host(host).alias("host"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"),
    )
    named = edits.withColumnsRenamed({k: f"edit_{k}" for k in keys})
    same = [keyed[k].eqNullSafe(named[f"edit_{k}"]) for k in keys]
    left = keyed.join(F.broadcast(named) if few else named, same, "left").where("kept IS NULL OR kept")
    held = F.filter(F.split(F.col("_row.text"), "\n", -1), lambda x: ~F.array_contains("removed", _line_key(x)))
    changed = F.col("removed").isNotNull()
    text = F.when(changed, F.array_join(held, "\n")).otherwise(F.col("_row.text"))
    out = left.withColumn("_text", text)
    made = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.when(changed, F.length("_text").cast(kind)).otherwise(F.col("_row.n_chars"))
    return out.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def _judged(docs: DataFrame, host: str, min_documents: int, min_share: float, min_kept_share: float) -> DataFrame:
    """The rows of :func:`quality_rules` with their host and the keys of their removed lines."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _host(host).alias("host"), "text")
    counted = written_in_slices(
        as_bytes(own, "host", "doc_id").mapInArrow(_counted, _COUNTED).withColumn("row", F.monotonically_increasing_id())
    )
    # Copies of a text fall together, on the map side where they can, before lines are counted.
    texts = counted.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))
    often = (
        texts.select("host", F.explode("lines.line").alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_documents)
    )
    if min_share > 0:
        sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
        often = often.join(sizes, "host").where(F.col("documents") >= F.col("host_documents") * min_share)
    # Removed lines meet the lines of every row; a line that is everywhere in a hot host is dealt by the row.
    removed = often.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    held = counted.select(
        "row", "host", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"), F.explode("lines").alias("held")
    ).select("row", "host", "salt", "held.line", "held.words")
    lost = held.join(removed, ["host", "line", "salt"]).groupBy("row").agg(
        F.sum("words").alias("lost"), F.array_sort(F.collect_list("line")).alias("removed")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        counted.drop("lines").join(lost, "row", "left")
        .withColumn("n_removed_words", F.coalesce("lost", F.lit(0).cast("bigint")))
        .withColumn("base_failed", failed)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= min_kept_share * F.col("n_words"))).alias("kept"),
            "n_removed_words", "text_key", "host",
            F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
        )
    )
