"""Comparing live marts with what was published: versions, restatements, tombstones, withheld keys.

Everything here is a pure function of DataFrames; `tidemark.plans.report` supplies and stores them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.contract import MARTS
from tidemark.operators.coverage import mart_feeds, mart_windows, window_days

KEY = ["tenant_id", "mart", "day", "dims"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _object(pairs: dict[str, str]):
    """Canonical JSON text with a fixed field order; an absent value is JSON null."""
    if not pairs:
        return F.lit("{}")
    fields = [F.col(column).cast("string").alias(name) for name, column in pairs.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def mart_keys(marts: dict[str, DataFrame]) -> DataFrame:
    """The given marts as one relation of (tenant_id, mart, day, dims, metrics)."""
    return _union([
        df.select(
            "tenant_id", F.lit(name).alias("mart"), "day",
            _object({d: d for d in MARTS[name].dims}).alias("dims"),
            _object({m: m for m in MARTS[name].metrics}).alias("metrics"),
        )
        for name, df in marts.items()
    ])


def lineage(staged: dict[str, DataFrame], marts: list[str] | None = None) -> DataFrame:
    """The distinct files feeding each mart key, unreadable amounts and uncounted types included."""
    parts = []
    for name in marts or list(MARTS):
        for feed in MARTS[name].feeds:
            rows = staged[feed.source].filter(F.col(feed.day).isNotNull())
            parts.append(rows.select(
                "tenant_id", F.lit(name).alias("mart"), F.col(feed.day).alias("day"),
                *[F.col(c).alias(d) for d, c in feed.dims.items()], "batch_file_id",
            ).distinct().select(
                "tenant_id", "mart", "day", _object({d: d for d in feed.dims}).alias("dims"), "batch_file_id"))
    return _union(parts).distinct()


def latest_published(published: DataFrame) -> DataFrame:
    """The latest version of each key, tombstones included."""
    newest = Window.partitionBy(*KEY).orderBy(F.desc("version"))
    return published.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def reported_metric(published: DataFrame) -> DataFrame:
    """What clients were last told: the latest version of each key, without tombstones."""
    return latest_published(published).filter("metrics IS NOT NULL")


def classify(current: DataFrame, latest: DataFrame, windows: DataFrame, marts: list[str] | None = None) -> DataFrame:
    """Every key with what a run does about it.

    `action` is new, unchanged, restated, tombstone or withheld; keys already tombstoned and still
    absent do not appear. `windows` are the incomplete windows per source.
    """
    was = latest.select(*KEY, "version", F.col("metrics").alias("before"), F.col("run_id").alias("previous_run"),
                        F.lit(True).alias("_was"))
    now = current.select(*KEY, F.col("metrics").alias("after"), F.lit(True).alias("_now"))
    held = window_days(mart_windows(windows, marts)).select("tenant_id", "mart", "day").distinct().withColumn(
        "_held", F.lit(True))
    both = now.join(was, KEY, "full_outer").join(held, ["tenant_id", "mart", "day"], "left")
    action = (
        F.when(F.col("_now").isNull() & F.col("before").isNull(), F.lit(None))
        .when(F.col("_held"), F.lit("withheld"))
        .when(F.col("_was").isNull(), F.lit("new"))
        .when(F.col("_now").isNull(), F.lit("tombstone"))
        .when(F.col("before") == F.col("after"), F.lit("unchanged"))
        .otherwise(F.lit("restated"))
    )
    return both.withColumn("action", action).filter("action IS NOT NULL").select(
        *KEY, "action", F.col("version").alias("from_version"),
        (F.coalesce("version", F.lit(0)) + 1).alias("to_version"), "before", "after", "previous_run")


def new_versions(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("action").isin("new", "restated", "tombstone")).select(
        *KEY, F.col("to_version").alias("version"), F.col("after").alias("metrics"))


def changed(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("action").isin("restated", "tombstone"))


def causes(changed_keys: DataFrame, feeding: DataFrame, run_files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Changed keys with `caused_by`: the files behind each change, ascending.

    Files that feed the key now and that the run of its previous version had not seen. Where none of
    them is new (rows only left the key), every loaded file of the mart's sources that run had not
    seen. What a run saw is kept as rows, so "not seen" is an anti join, not an array test per key.
    """
    seen = run_files.select("tenant_id", F.col("run_id").alias("previous_run"), "batch_file_id")
    keys = changed_keys.select(*KEY, "previous_run")
    direct = (
        keys.join(feeding, KEY)
        .join(seen, ["tenant_id", "previous_run", "batch_file_id"], "left_anti")
        .groupBy(*KEY).agg(F.array_sort(F.collect_list("batch_file_id")).alias("_direct"))
    )
    per_run = changed_keys.select("tenant_id", "mart", "previous_run").distinct()
    since = (
        per_run.join(mart_feeds(loaded.select("tenant_id", "source", "batch_file_id")), ["tenant_id", "mart"])
        .join(seen, ["tenant_id", "previous_run", "batch_file_id"], "left_anti")
        .groupBy("tenant_id", "mart", "previous_run")
        .agg(F.array_sort(F.collect_set("batch_file_id")).alias("_since"))
    )
    caused_by = F.coalesce("_direct", "_since", F.array().cast("array<bigint>"))
    return (
        changed_keys.join(direct, KEY, "left")
        .join(since, ["tenant_id", "mart", "previous_run"], "left")
        .withColumn("caused_by", caused_by).drop("_direct", "_since")
    )


def withheld_keys(classified: DataFrame, windows: DataFrame, marts: list[str] | None = None) -> DataFrame:
    """One row per incomplete window of a mart and key it holds back.

    A key inside two windows is listed in both; a window holding nothing back has one row without a key.
    """
    open_windows = mart_windows(windows, marts)
    columns = ["tenant_id", "mart", "source", "batch_no", "path", "covers_from", "covers_to", "status"]
    keys = classified.filter("action = 'withheld'").select(*KEY)
    inside = window_days(open_windows).join(keys, ["tenant_id", "mart", "day"]).select(*columns, "day", "dims")
    none = open_windows.join(
        inside.select("tenant_id", "mart", "source", "batch_no").distinct(),
        ["tenant_id", "mart", "source", "batch_no"], "left_anti",
    ).select(*columns, F.lit(None).cast("date").alias("day"), F.lit(None).cast("string").alias("dims"))
    return inside.unionByName(none)


def summary(classified: DataFrame) -> DataFrame:
    """Per tenant: versions written, restatements, unchanged and withheld keys."""
    def count(*actions: str):
        return F.count_if(F.col("action").isin(*actions))

    return classified.groupBy("tenant_id").agg(
        count("new", "restated", "tombstone").alias("published"), count("restated", "tombstone").alias("restated"),
        count("unchanged").alias("unchanged"), count("withheld").alias("withheld"))


def history(published: DataFrame, restatement: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every version of every key; a restated one with the number before it and each causing file."""
    why = restatement.select(
        *KEY, F.col("to_version").alias("version"), "before", F.explode_outer("caused_by").alias("batch_file_id"))
    paths = ledger.select("tenant_id", "batch_file_id", "path")
    return published.select(*KEY, "version", "metrics", "run_id").join(
        why.join(paths, ["tenant_id", "batch_file_id"], "left"), [*KEY, "version"], "left")
