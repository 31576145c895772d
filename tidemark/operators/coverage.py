"""Expected batches against the ledger: what arrived, what did not, and which days that leaves open."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.contract import MARTS
from tidemark.functions.casts import first_real_day, last_real_day


def attempts(ledger: DataFrame) -> DataFrame:
    """One row per (tenant, source, batch) that was ever attempted."""
    return ledger.groupBy("tenant_id", "source", "batch_no").agg(
        F.max(F.col("status") == "loaded").alias("any_loaded"),
        F.count(F.lit(1)).alias("n_attempts"),
        F.max_by("reasons", "batch_file_id").alias("last_reasons"),
        F.min(F.when(F.col("status") == "loaded", F.col("batch_file_id"))).alias("loaded_id"),
    )


def batch_status(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each manifest batch with `status`: loaded, quarantined (attempted, never loaded) or not_received."""
    status = (
        F.when(F.col("n_attempts").isNull(), F.lit("not_received"))
        .when(F.col("any_loaded"), F.lit("loaded"))
        .otherwise(F.lit("quarantined"))
    )
    return manifest.join(attempts(ledger), ["tenant_id", "source", "batch_no"], "left").select(
        "tenant_id", "source", "batch_no", "path", "covers_from", "covers_to", status.alias("status"),
        "last_reasons", "loaded_id",
    )


def incomplete_windows(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Manifest batches with no loaded attempt."""
    return batch_status(manifest, ledger).filter("status <> 'loaded'").drop("last_reasons", "loaded_id")


def mart_feeds(df: DataFrame, marts: list[str] | None = None) -> DataFrame:
    """Repeat each row of `df` (which has `source`) for every mart fed by its source."""
    fed = {}
    for mart in marts or list(MARTS):
        for feed in MARTS[mart].feeds:
            fed.setdefault(feed.source, []).append(mart)
    choose = F.lit(None).cast("array<string>")
    for source, names in fed.items():
        choose = F.when(F.col("source") == source, F.array(*map(F.lit, names))).otherwise(choose)
    return df.withColumn("mart", F.explode(choose))


def mart_windows(windows: DataFrame, marts: list[str] | None = None) -> DataFrame:
    return mart_feeds(windows, marts)


def window_days(windows: DataFrame) -> DataFrame:
    """Each window repeated for every calendar day in it, bounds included.

    Turns the range condition "day inside window" into an equality, so keys meet windows in an
    ordinary hash join. A window text that is no real day covers the real days text order puts inside.
    """
    first, last = first_real_day(F.col("covers_from")), last_real_day(F.col("covers_to"))
    return windows.withColumn("day", F.explode(F.when(first <= last, F.sequence(first, last))))
