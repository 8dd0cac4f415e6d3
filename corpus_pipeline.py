"""A corpus pipeline of five stages over ``documents``, each written and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import pii
from stockledger.llm.jaccard import jaccard_join
from stockledger.llm.lines import cleaned
from stockledger.llm.pieces import encode_decode
from stockledger.llm.queries import piece_model, table
from stockledger.llm.shared import semi, shared_folder, without, written
from stockledger.llm.tiling import decontaminated

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that too many texts of their source hold.

    Null, empty and short texts go; a null source is a source of its own; of rows that are repeated each is judged. Very long
    texts are judged whole. No row: no row. Columns beside those of documents are left behind.
    """
    return cleaned(_documents(docs), min_share=0)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; of a row that is repeated, one.

    Null and empty texts are in no group and stay, and so do rows without an id.
    """
    copies = jaccard_join(docs).where("component_id <> doc_id").select("doc_id").distinct()
    firsts = without(_documents(docs), written(copies), "doc_id")
    repeated = written(docs.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id"))
    again = semi(firsts, repeated, "doc_id").dropDuplicates(["doc_id", "text"])
    return without(firsts, repeated, "doc_id").unionByName(again)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold an item of the benchmark.

    Null and empty texts hold none and stay; a row that is repeated goes or stays with all its copies; rows without an id are
    judged like others. Without items, or without documents, nothing changes.
    """
    return decontaminated(_documents(docs), table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by its kind; n_chars follows. Null texts stay null, with the n_chars they had."""
    changed = pii.redact(_documents(docs))
    return changed.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, counted and hashed, and the hash of what they decode to.

    A null text is an empty one and has the end id only; repeated rows and rows without an id give a row each.
    """
    return encode_decode(docs, piece_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard", deduplicated),
    ("decontamination", clean_of_benchmark),
    ("pii", redacted),
    ("sentencepiece", encoded),
]

# Trees, tiles and pieces have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
