"""Joins whose left side may have keys holding a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def skewed_left_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """`left` left-joined with `right`, which has at most one row per key.

    AQE splits a hot left partition over several tasks, but only where the shuffle is the join's own.
    `right` usually comes out of an aggregate on the same columns and would be joined without a shuffle of
    its own; joining on one struct of the key columns gives both sides theirs. The struct is never NULL,
    so rows with a NULL key stay in the join (they match nothing) and are split like any other hot key.
    """
    keyed_left = left.withColumn("_key", F.struct(*on))
    keyed_right = right.select(F.struct(*on).alias("_key"), *[c for c in right.columns if c not in on])
    return keyed_left.join(keyed_right, "_key", "left").drop("_key")
