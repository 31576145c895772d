"""Resolving delivered headers against a source's columns and a tenant's declared aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.contract import REASONS_TYPE, SOURCE_COLUMNS
from tidemark.functions.values import clip, reason
from tidemark.session import small_frame


def header_rules(spark: SparkSession, alias: DataFrame, configured: DataFrame) -> DataFrame:
    """Per (tenant_id, source): `accepts` header -> canonical column, and the `required` columns in order."""
    columns = small_frame(
        spark, [(s, i, c) for s, cs in SOURCE_COLUMNS.items() for i, c in enumerate(cs)],
        "source string, position int, canonical string")
    own = configured.select("tenant_id", "source").join(columns.select("source", "canonical"), "source").select(
        "tenant_id", "source", F.col("canonical").alias("header"), "canonical")
    declared = alias.select("tenant_id", "source", F.col("alias").alias("header"), "canonical")
    accepted = own.unionByName(declared).groupBy("tenant_id", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("header", "canonical"))).alias("accepts"))
    required = columns.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("position", "canonical"))).alias("r"))
    return accepted.join(required.select("source", F.col("r.canonical").alias("required")), "source")


def _quoted(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def resolve(headers: Column, accepts: Column, required: Column, source: Column) -> Column:
    """struct(columns, reasons) for one header list.

    Headers are judged left to right: a repeat, then an unknown name, then a column another header
    already carries; after them every column nobody carries. `columns` is only meaningful when there
    are no reasons.
    """
    def judged(header: Column, i: Column) -> Column:
        column = F.try_element_at(accepts, header)
        before = F.slice(headers, 1, i)
        rival = F.try_element_at(
            F.filter(before, lambda h: F.try_element_at(accepts, h) == column), F.lit(1))
        repeated = F.array_contains(before, header)
        return (
            F.when(repeated, reason("duplicate_header", _quoted('header "', clip(header), '" appears more than once')))
            .when(column.isNull(), reason("unknown_header", _quoted(
                'header "', clip(header), '" is neither a column of ', source, " nor a declared alias")))
            .when(rival.isNotNull(), reason("ambiguous_column", _quoted(
                'headers "', clip(rival), '" and "', clip(header), '" both map to column "', column, '"')))
        )

    found = F.filter(F.transform(headers, judged), lambda r: r.isNotNull())
    carried = F.transform(headers, lambda h: F.try_element_at(accepts, h))
    absent = F.transform(
        F.filter(required, lambda c: ~F.coalesce(F.array_contains(F.array_compact(carried), c), F.lit(False))),
        lambda c: reason("missing_column", _quoted('column "', c, '" is missing')))
    known = F.array_distinct(F.filter(headers, lambda h: F.try_element_at(accepts, h).isNotNull()))
    columns = F.map_from_arrays(known, F.transform(known, lambda h: F.try_element_at(accepts, h)))
    return F.struct(columns.alias("columns"), F.concat(found, absent).cast(REASONS_TYPE).alias("reasons"))


def resolve_headers(files: DataFrame, rules: DataFrame) -> DataFrame:
    """Add `columns` and `reasons` to files with (tenant_id, source, headers)."""
    joined = files.join(rules, ["tenant_id", "source"])
    resolved = resolve(F.col("headers"), F.col("accepts"), F.col("required"), F.col("source"))
    return joined.withColumn("_r", resolved).select(*files.columns, F.col("_r.columns").alias("columns"), F.col("_r.reasons").alias("reasons"))
