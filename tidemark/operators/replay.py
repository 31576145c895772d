"""Which delivered files are new: compared with what is loaded, and with each other inside one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.contract import REASONS_TYPE
from tidemark.functions.values import reason
from tidemark.operators.skew import skewed_left_join


def duplicate_reason(batch):
    return reason("duplicate_content", F.format_string(
        "file has the same content as batch %s, which is already loaded", batch.cast("string")))


def classify_replays(files: DataFrame, ledger: DataFrame, configured: DataFrame) -> DataFrame:
    """Add `verdict` (skipped, quarantined or parse), `reasons` and `earlier_rows` to delivered files.

    `files` has (tenant_id, source, batch_no, sha256, ...). Only loaded files count, so a quarantined
    delivery can be tried again.
    """
    loaded = ledger.filter("status = 'loaded'")
    by_batch = loaded.groupBy("tenant_id", "source", "batch_no").agg(
        F.min("sha256").alias("batch_sha"), F.min("row_count").alias("batch_rows"))
    by_sha = loaded.groupBy("tenant_id", "source", "sha256").agg(F.min("batch_no").alias("sha_batch"))
    known = configured.select("tenant_id", "source", F.lit(True).alias("_configured"))
    # Copies of one content may be a large share of all files, so the hash join must not collect them.
    seen = skewed_left_join(
        files.join(by_batch, ["tenant_id", "source", "batch_no"], "left"), by_sha, ["tenant_id", "source", "sha256"]
    ).join(known, ["tenant_id", "source"], "left")
    same = F.col("batch_sha") == F.col("sha256")
    conflict = reason("batch_conflict", F.format_string(
        "batch %s was already loaded with different content (sha256 %s)", F.col("batch_no").cast("string"), "batch_sha"))
    unknown = reason("source_not_configured", F.format_string("%s has no %s source", "tenant_id", "source"))
    why = (
        F.when(same, F.lit(None))
        .when(F.col("batch_sha").isNotNull(), F.array(conflict))
        .when(F.col("sha_batch").isNotNull(), F.array(duplicate_reason(F.col("sha_batch"))))
        .when(F.col("_configured").isNull(), F.array(unknown))
    )
    verdict = F.when(same, F.lit("skipped")).when(F.col("reasons").isNotNull(), F.lit("quarantined")).otherwise(F.lit("parse"))
    return seen.withColumn("reasons", why.cast(REASONS_TYPE)).withColumn("verdict", verdict).withColumn(
        "earlier_rows", F.when(same, F.col("batch_rows"))
    ).drop("batch_sha", "batch_rows", "sha_batch", "_configured")


def first_of_content(files: DataFrame) -> DataFrame:
    """Add `first_batch`: the lowest batch among files of a (tenant, source) with equal bytes.

    Of several equal files in one run only that one loads.
    """
    first = files.groupBy("tenant_id", "source", "sha256").agg(F.min("batch_no").alias("first_batch"))
    return skewed_left_join(files, first, ["tenant_id", "source", "sha256"])
