"""What a task holds of its texts at once: Arrow batches are bounded by bytes, and no text is sent twice."""

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from tidemark.llm.texts import annotate, map_batches
from tidemark.session import BATCH_BYTES


def sizes(rows):
    def run(batches):  # inside, so that it is sent by value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    return map_batches(rows, run, "n long, bytes long").collect()


def long_texts(spark, rows, size):
    return spark.range(0, rows, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), size).alias("text"))


def test_batches_are_bounded_by_bytes(spark):
    found = sizes(long_texts(spark, 1500, 10_000))
    assert sum(r.n for r in found) == 1500
    assert max(r.bytes for r in found) < BATCH_BYTES + 100_000  # 15 MB in one batch before


def test_a_text_longer_than_a_batch_is_whole(spark):
    found = sizes(long_texts(spark, 3, 2 * BATCH_BYTES))
    assert sorted(r.n for r in found) == [1, 1, 1] and min(r.bytes for r in found) > 2 * BATCH_BYTES


def test_kept_texts_are_sent_once(spark):
    rows = [(1, "a b", "x"), (2, None, "y"), (None, "", None), (4, "c", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    found = annotate(docs, ["lang", "text", "doc_id"], T.StructType.fromDDL("size long"), lambda part: [pa.array(part.off[1:] - part.off[:-1], pa.int64())])
    assert {tuple(r) for r in found.collect()} == {("x", "a b", 1, 3), ("y", None, 2, 0), (None, "", None, 0), ("z", "c", 4, 1)}
    plan = found._jdf.queryExecution().optimizedPlan()
    assert found.columns == ["lang", "text", "doc_id", "size"]
    assert plan.children().head().output().size() == 3  # the texts twice before: four columns
