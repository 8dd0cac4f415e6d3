"""What tasks hold at once: batches of rows with texts are no larger than the slices they are worked on in."""

import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter

import corpus_pipeline
from stockledger.llm import shared


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])


def test_batches_are_slices(spark):
    rows = spark.range(5_000, numPartitions=1).selectExpr("id", "CAST(repeat('x', 2000) AS binary) AS text")
    before = spark.conf.get(shared.BATCH_BYTES)
    got = shared.written_in_slices(rows.mapInArrow(_sizes, "n bigint, size bigint")).collect()
    assert sum(r.n for r in got) == 5_000 and max(r.size for r in got) < 1.1 * shared.SLICE_BYTES
    assert spark.conf.get(shared.BATCH_BYTES) == before


def test_the_bound_is_put_back_after_a_failure(spark):
    before = spark.conf.get(shared.BATCH_BYTES)
    with pytest.raises(ZeroDivisionError), shared.small_batches(spark):
        1 / 0
    assert spark.conf.get(shared.BATCH_BYTES) == before


@pytest.mark.parametrize("name", ["quality_rules", "ngram_jaccard", "decontamination"])
def test_stages_hand_texts_over_in_slices(spark, data, monkeypatch, name):
    """Every write that sends texts through Python does so under the bound."""
    seen, write = [], DataFrameWriter.parquet

    def noted(self, *args, **more):
        plan = self._df._jdf.queryExecution().optimizedPlan().toString()
        if "InArrow" in plan and any(x in plan for x in ("text#", "p#", "signs#", "asked#")):
            seen.append(spark.conf.get(shared.BATCH_BYTES))
        return write(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    shared.written(dict(corpus_pipeline.STAGES)[name](spark, docs, data))
    assert seen and set(seen) == {str(shared.SLICE_BYTES)}
