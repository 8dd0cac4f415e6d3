"""The registered queries of the text operators, and their SQL twins where SQL can say them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import chat, lines, oracles, pii
from stockledger.llm.audit import source_divergence
from stockledger.llm.exact import exact_duplicates
from stockledger.llm.jaccard import jaccard_join
from stockledger.llm.passages import near_passages
from stockledger.llm.pieces import encode_decode
from stockledger.llm.quality import quality_scores
from stockledger.llm.shards import shard_by_bytes
from stockledger.llm.suffixes import substring_dedup
from stockledger.llm.tiling import contaminated
from stockledger.llm.zones import cluster


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("n_verified")


def op6_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage from both its documents, so that each document with one has rows of its own."""
    names = ["doc_id", "other_doc_id", "a_start", "a_end", "b_start", "b_end", "similarity"]

    def seen_from(one: str, other: str):
        ends = [f"{side}_{end}" for side in (one, other) for end in ("start", "end")]
        return F.struct(*[F.col(c).alias(n) for c, n in zip([one, other, *ends, "similarity"], names)])

    found = near_passages(table(spark, sf_dir, "documents"))
    return found.select(F.inline(F.array(seen_from("a", "b"), seen_from("b", "a"))))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), piece_model())


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality_rules(table(spark, sf_dir, "documents")).drop("text_key")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ok).alias("text"),
    )
    parts = rows.unionByName(more).withColumn("parts", chat.text_part(F.col("text")))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return chat.read_back(chat.format_chat(parts)).select(
        "conv_id", "n_turns",
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op9_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard_by_bytes(rows, "size", 24, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_segment_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_zone_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def op13_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("chain")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_boosted_pii": op1_boosted_pii,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_compact_windows": op3_compact_windows,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_random_indexing": op6_random_indexing,
    "op7_line_frequency": op7_line_frequency,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_histogram_sort": op9_histogram_sort,
    "op10_string_tiling": op10_string_tiling,
    "op11_segment_trees": op11_segment_trees,
    "op12_zone_maps": op12_zone_maps,
    "op13_extendible_hash": op13_extendible_hash,
}

ORACLES: dict[str, str] = {
    "op5_ngram_jaccard": oracles.OP5,
    "op7_line_frequency": oracles.op7(lines.MIN_DOCUMENTS, lines.MIN_SHARE, lines.MIN_KEPT_SHARE),
    "op8_chat_formatting": oracles.OP8,
    "op11_segment_trees": oracles.OP11,
    "op12_zone_maps": oracles.op12(),
    "op13_extendible_hash": oracles.OP13,
}
