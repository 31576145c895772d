"""The manifest: which batch files a delivery is supposed to contain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contract import ISO_DATE, MANIFEST_SCHEMA, SOURCES
from tidemark.session import listed


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest entries as written, in (tenant_id, source, batch_no, path, covers_from, covers_to)."""
    raw = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    entry = raw.select(F.posexplode("batches").alias("position", "e"))
    return entry.select(
        "position", F.col("e.tenant").alias("tenant_id"), "e.source", F.col("e.batch").alias("batch_no"), "e.path",
        "e.covers_from", "e.covers_to")


def manifest_problems(entries: DataFrame) -> DataFrame:
    """One row (position, message) per broken manifest rule."""
    key = F.concat_ws("/", "tenant_id", "source", "batch_no")
    dates = F.coalesce(F.col("covers_from").rlike(ISO_DATE) & F.col("covers_to").rlike(ISO_DATE), F.lit(False))
    rules = [
        (F.coalesce(F.length("tenant_id"), F.lit(0)) == 0, F.lit("tenant is missing")),
        (~F.coalesce(F.col("source").isin(SOURCES), F.lit(False)), F.lit("source is not one of " + ", ".join(SOURCES))),
        (~F.coalesce(F.col("batch_no") > 0, F.lit(False)), F.lit("batch must be a positive whole number")),
        (F.coalesce(F.length("path"), F.lit(0)) == 0, F.lit("path is missing")),
        (~dates, F.lit("covers_from and covers_to must be YYYY-MM-DD")),
        (F.col("covers_from") > F.col("covers_to"), F.concat(
            F.lit("batch "), key, F.lit(" covers "), "covers_from", F.lit(" to "), "covers_to",
            F.lit(": covers_from is after covers_to"))),
    ]
    broken = entries.select("position", F.explode(F.array(*[F.when(bad, text) for bad, text in rules])).alias("message"))
    listed = entries.groupBy("tenant_id", "source", "batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("position").alias("position")).filter("n > 1")
    twice = listed.select("position", F.concat(F.lit("batch "), key, F.lit(" is listed twice")).alias("message"))
    return broken.filter("message IS NOT NULL").unionByName(twice)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest that follows every rule; any violation refuses it as a whole."""
    entries = scan_manifest(spark, path)
    problems = listed(manifest_problems(entries).select(
        "position", F.concat(F.lit("batches."), F.col("position"), F.lit(": "), F.col("message")).alias("text")))
    if problems:
        raise ValueError(f"Invalid manifest {path}:\n" + "\n".join(problems))
    return entries.select(
        "tenant_id", "source", F.col("batch_no").cast("int").alias("batch_no"), "path", "covers_from", "covers_to")
