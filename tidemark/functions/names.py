"""Batch ranges, batch gaps and near-miss names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def batch_ranges(df: DataFrame, keys: list[str], batch: str = "batch_no") -> DataFrame:
    """Per key the runs of consecutive batch numbers as text: 1, 3, 4, 5 -> "batches 1, 3-5"."""
    distinct = df.select(*keys, F.col(batch).alias("b")).distinct()
    in_order = Window.partitionBy(*keys).orderBy("b")
    runs = distinct.withColumn("island", F.col("b") - F.row_number().over(in_order)).groupBy(*keys, "island").agg(
        F.min("b").alias("first"), F.max("b").alias("last"), F.count(F.lit(1)).alias("n"))
    one = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(
        F.concat_ws("-", "first", "last"))
    listed = runs.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("first", one.alias("text")))).alias("runs"), F.sum("n").alias("n"))
    text = F.array_join(F.transform("runs", lambda r: r["text"]), ", ")
    return listed.select(
        *keys, F.concat(F.when(F.col("n") == 1, F.lit("batch ")).otherwise(F.lit("batches ")), text).alias("batches"))


#: Numbers that are put into one array at a time, and the longest gap whose numbers a message writes out.
CHUNK, WRITTEN_OUT = 10_000, 100


def batch_gaps(df: DataFrame, keys: list[str], batch: str = "batch_no") -> DataFrame:
    """The runs of batch numbers from 1 up to a key's highest that it skips: one row (first, last) a run.

    There are no more runs than numbers that are there, however far apart these are.
    """
    present = df.select(*keys, F.col(batch).cast("int").alias("b")).distinct()
    before = present.withColumn("previous", F.lag("b", 1, 0).over(Window.partitionBy(*keys).orderBy("b")))
    return before.filter("b > previous + 1").select(
        *keys, (F.col("previous") + 1).alias("first"), (F.col("b") - 1).alias("last"))


def skipped_numbers(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """Every number of the gaps, one row each; no array holds a whole gap."""
    starts = gaps.select(*keys, "last", F.explode(F.sequence("first", "last", F.lit(CHUNK))).alias("start"))
    # Not start + CHUNK first: that could pass the largest int.
    end = F.col("start") + F.least(F.lit(CHUNK - 1), F.col("last") - F.col("start"))
    return starts.select(*keys, F.explode(F.sequence("start", end)).alias("missing"))


def gap_texts(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """Per key how many numbers are skipped, `n`, and which: 1, 3, 4. A gap of more than WRITTEN_OUT is given as 7-900."""
    numbers = F.when(
        F.col("last") - F.col("first") < WRITTEN_OUT,
        F.array_join(F.sequence("first", "last"), ", "),
    ).otherwise(F.concat_ws("-", "first", "last"))
    listed = gaps.groupBy(*keys).agg(
        F.sum(F.col("last").cast("bigint") - F.col("first") + 1).alias("n"),
        F.array_sort(F.collect_list(F.struct("first", numbers.alias("text")))).alias("runs"))
    return listed.select(*keys, "n", F.array_join(F.col("runs.text"), ", ").alias("batches"))


def _without_one(text: Column) -> Column:
    """Every text made by leaving out one character."""
    return F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.concat(text.substr(F.lit(1), i - 1), text.substr(i + 1, F.length(text))))


def deletions(text: Column) -> Column:
    """The text and every text made by leaving out one or two of its characters."""
    one = F.when(F.length(text) > 0, _without_one(text)).otherwise(F.array().cast("array<string>"))
    two = F.flatten(F.transform(one, lambda t: F.when(F.length(t) > 0, _without_one(t)).otherwise(
        F.array().cast("array<string>"))))
    return F.array_distinct(F.concat(F.array(text), one, two))


def near_misses(names: DataFrame, candidates: DataFrame, within: list[str]) -> DataFrame:
    """Candidates that look like a typo of a name: equal ignoring case, or at most two edits away.

    `names` and `candidates` have the `within` columns plus `name` and `candidate`. Two texts at most two
    edits apart share a text made by leaving out at most two characters of each, so pairs are found by
    an equality join on those and no name is compared with every candidate.
    """
    left = names.select(*within, "name").distinct()
    right = candidates.select(*within, "candidate").distinct()
    close = (
        left.withColumn("_v", F.explode(deletions(F.col("name"))))
        .join(right.withColumn("_v", F.explode(deletions(F.col("candidate")))), [*within, "_v"])
        .filter(F.levenshtein("name", "candidate") <= 2)
    )
    same = left.withColumn("_v", F.lower("name")).join(right.withColumn("_v", F.lower("candidate")), [*within, "_v"])
    pairs = close.unionByName(same).drop("_v").filter("name <> candidate").distinct()
    return pairs.withColumn("distance", F.levenshtein("name", "candidate"))


def best_match(pairs: DataFrame, within: list[str]) -> DataFrame:
    """The closest candidate of each name; ties go to the first in text order."""
    return pairs.groupBy(*within, "name").agg(
        F.min(F.struct("distance", "candidate")).getField("candidate").alias("suggestion"))
