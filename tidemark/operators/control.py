"""Changes needed to make stored control tables equal to the configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAP_KEY = ["tenant_id", "source", "column_name", "raw_value"]


def tenant_changes(stored: DataFrame, desired: DataFrame) -> DataFrame:
    """Tenants to insert, or to update because the name or currency differs."""
    was = stored.select("tenant_id", F.struct("display_name", "currency").alias("was"))
    both = desired.join(was, "tenant_id", "left")
    action = F.when(F.col("was").isNull(), F.lit("insert")).when(
        ~F.struct("display_name", "currency").eqNullSafe(F.col("was")), F.lit("update"))
    return both.select("tenant_id", "display_name", "currency", action.alias("action")).filter("action IS NOT NULL")


def merged_tenants(stored: DataFrame, desired: DataFrame) -> DataFrame:
    """Desired tenants, plus stored ones the configuration does not mention."""
    columns = ["tenant_id", "display_name", "currency"]
    return desired.select(*columns).unionByName(
        stored.select(*columns).join(desired.select("tenant_id"), "tenant_id", "left_anti"))


def value_map_changes(stored: DataFrame, desired: DataFrame) -> DataFrame:
    """Rows to `remove` (gone or changed) and to `add`, for the tenants in `desired` or `stored`."""
    row = [*MAP_KEY, "canonical_value"]
    removed = stored.select(*row).join(desired.select(*row), row, "left_anti").withColumn("action", F.lit("remove"))
    added = desired.select(*row).join(stored.select(*row), row, "left_anti").withColumn("action", F.lit("add"))
    return removed.unionByName(added)
