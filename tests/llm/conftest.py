from __future__ import annotations

import pytest

# Columns an operator might use itself, and rows of every awkward kind.
CLASHING = ["key", "bucket", "label", "label_", "spans", "found", "shard", "size", "n_words", "component_id", "score"]


@pytest.fixture(scope="session")
def documents(spark, data):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def framed(spark):
    """Rows (doc_id, text) as documents with columns that clash."""

    def build(rows):
        whole = [(d, t, "en", "src0" if d is None or d % 3 else None, 0, *range(len(CLASHING))) for d, t in rows]
        columns = ", ".join(f"{c} bigint" for c in CLASHING)
        schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {columns}"
        return spark.createDataFrame(whole, schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls, empty and very long texts, ties, repeated rows, ids with two texts."""
    one, two = documents[3][1], documents[4][1]
    return [
        (900_000, None), (900_001, ""), (900_002, " \n\t "), (900_003, "a" * 300_000), (900_004, "word " * 30_000),
        (900_005, one), (900_005, one), (900_006, two), (900_006, one + " tail"), (900_007, "\x00" * 80), (900_008, "\x00" * 70),
        (900_009, one + " tail"), (None, two), (None, None), (900_010, "x" * 49), (900_011, "x" * 49), (900_012, "y" * 50), (900_013, "y" * 50),
        (900_014, "one two three"), (900_015, "ONE two three"), (900_016, "▁ two  spaces ▁▁ é ﬁ 日本🤖 "),
    ]
