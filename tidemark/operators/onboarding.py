"""Checks on the values of a delivery before it is loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.contract import CLOSED_VALUES, MAPPED_COLUMNS, REVENUE_CHANNEL, SPEND_CHANNEL
from tidemark.session import small_frame

COLUMN = ["tenant_id", "source", "column_name"]


def value_tally(texts: dict[str, DataFrame]) -> DataFrame:
    """Rows per raw value of every mapped column, with the value it maps to.

    `texts` are lines as `staging.canonical_text` gives them, per source.
    """
    parts = []
    for source, df in texts.items():
        for column in MAPPED_COLUMNS[source]:
            parts.append(
                df.filter(F.col(f"raw_{column}").isNotNull())
                .groupBy("tenant_id", F.col(f"raw_{column}").alias("raw_value"), F.col(column).alias("value"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .select("tenant_id", F.lit(source).alias("source"), F.lit(column).alias("column_name"),
                        "raw_value", "value", "rows"))
    return reduce(DataFrame.unionByName, parts)


def _closed(tally: DataFrame) -> DataFrame:
    rows = [(s, c) for s, c in CLOSED_VALUES]
    return small_frame(tally.sparkSession, rows, "source string, column_name string")


def uncounted_raw(tally: DataFrame) -> DataFrame:
    """Values of closed columns that no mart would count."""
    allowed = small_frame(
        tally.sparkSession, [(s, c, v) for (s, c), vs in CLOSED_VALUES.items() for v in vs],
        "source string, column_name string, value string")
    here = tally.join(_closed(tally), ["source", "column_name"], "left_semi")
    return here.join(allowed, ["source", "column_name", "value"], "left_anti").select(tally.columns)


def open_values(tally: DataFrame) -> DataFrame:
    """Rows per mapped value of the open columns."""
    here = tally.join(_closed(tally), ["source", "column_name"], "left_anti")
    return here.groupBy(*COLUMN, "value").agg(F.sum("rows").alias("rows"))


def unmapped_values(tally: DataFrame, value_map: DataFrame) -> DataFrame:
    """Where an open column has a map: raw values that are neither in it nor one of its targets."""
    here = tally.join(_closed(tally), ["source", "column_name"], "left_anti")
    has_map = value_map.select(*COLUMN).distinct()
    keys = value_map.select(*COLUMN, "raw_value")
    targets = value_map.select(*COLUMN, F.col("canonical_value").alias("raw_value"))
    known = keys.unionByName(targets).distinct()
    return here.join(has_map, COLUMN, "left_semi").join(known, [*COLUMN, "raw_value"], "left_anti").select(tally.columns)


def unused_value_maps(value_map: DataFrame) -> DataFrame:
    """Maps on columns staging never maps."""
    mapped = small_frame(
        value_map.sparkSession, [(s, c) for s, cs in MAPPED_COLUMNS.items() for c in cs], "source string, column_name string")
    return value_map.select(*COLUMN).distinct().join(mapped, ["source", "column_name"], "left_anti").select(*COLUMN)


def channel_mismatch(tally: DataFrame) -> DataFrame:
    """Channels with revenue but no spend, and with spend but no revenue, for tenants delivering both."""
    def values(source: str, column: str) -> DataFrame:
        return tally.filter((F.col("source") == source) & (F.col("column_name") == column)).select("tenant_id", "value").distinct()

    revenue, spend = values(*REVENUE_CHANNEL), values(*SPEND_CHANNEL)
    both = revenue.select("tenant_id").distinct().join(spend.select("tenant_id").distinct(), "tenant_id")

    def only(here: DataFrame, there: DataFrame, side: str) -> DataFrame:
        return here.join(both, "tenant_id", "left_semi").join(there, ["tenant_id", "value"], "left_anti").withColumn("side", F.lit(side))

    return only(revenue, spend, "revenue").unionByName(only(spend, revenue, "spend"))
