"""Reading canonical values out of raw payloads, and shaping header and reason columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.contract import MAX_QUOTED, MAX_REASONS, REASONS_TYPE


def readers(columns: Column) -> Column:
    """canonical column -> the raw keys that carry it, in key order, from a raw -> canonical map.

    Computed once per file on the ledger side, so that row-level code only indexes into it.
    """
    canonical = F.array_distinct(F.map_values(columns))
    keys = F.transform(canonical, lambda c: F.array_sort(F.map_keys(F.map_filter(columns, lambda k, v: v == c))))
    return F.map_from_arrays(canonical, keys)


def column_value(payload: Column, keys: Column, width: int | None = None) -> Column:
    """The first non-blank value among the raw `keys`, spaces trimmed; NULL when all are blank.

    `width` is the most keys any file uses for the column. When given, the expression is a plain
    coalesce that stays inside generated code; otherwise it is a filter over the key array.
    """
    def clean(key: Column) -> Column:
        return F.nullif(F.btrim(payload[key]), F.lit(""))

    if width is not None:
        return F.coalesce(*[clean(F.get(keys, F.lit(i))) for i in range(max(width, 1))])
    return F.try_element_at(F.filter(F.transform(keys, clean), lambda v: v.isNotNull()), F.lit(1))


def reader_width(ledger: DataFrame) -> int:
    """The most raw keys any loaded file maps to one column (a small aggregate over the ledger)."""
    sizes = F.transform(F.map_values(readers(F.col("columns"))), lambda ks: F.size(ks))
    row = ledger.filter("status = 'loaded'").agg(F.max(F.array_max(sizes)).alias("w")).first()
    return (row and row["w"]) or 1


def map_values(df: DataFrame, value_map: DataFrame, source: str, column_name: str, column: str) -> DataFrame:
    """Replace `column` by its canonical value, or leave it when the tenant's map has no entry."""
    entries = value_map.filter((F.col("source") == source) & (F.col("column_name") == column_name)).select(
        F.col("tenant_id"), F.col("raw_value").alias(column), F.col("canonical_value").alias("_canonical")
    )
    joined = df.join(entries, ["tenant_id", column], "left")
    return joined.withColumn(column, F.coalesce("_canonical", column)).drop("_canonical").select(df.columns)


def clip(text: Column) -> Column:
    """At most 100 characters of quoted file text, with an ellipsis when cut."""
    return F.when(F.length(text) > MAX_QUOTED, F.concat(F.substring(text, 1, MAX_QUOTED), F.lit("…"))).otherwise(text)


def reason(code: str, message: Column | str, line: Column | None = None) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    at = F.lit(None).cast("int") if line is None else line.cast("int")
    return F.struct(F.lit(code).alias("code"), text.alias("message"), at.alias("line"))


def cap_reasons(reasons: Column, total: Column | None = None) -> Column:
    """The first 20 reasons, then one `truncated` reason counting the rest.

    `total` is how many there were when `reasons` already holds only the first ones.
    """
    count = F.size(reasons) if total is None else total
    rest = reason("truncated", F.format_string("%d more problems not listed", (count - MAX_REASONS).cast("long")))
    return F.when(
        count > MAX_REASONS, F.concat(F.slice(reasons, 1, MAX_REASONS), F.array(rest))
    ).otherwise(reasons).cast(REASONS_TYPE)


def adapted(columns: Column) -> Column:
    """The headers that were read through a declared alias."""
    return F.map_filter(columns, lambda header, column: header != column)


def reason_codes(reasons: Column) -> Column:
    """Distinct codes in order of first appearance."""
    return F.array_distinct(F.transform(F.coalesce(reasons, F.array().cast(REASONS_TYPE)), lambda r: r["code"]))


def last_wins(pairs: Column) -> Column:
    """A parsed JSON map in which a key written twice has its last value, as JSON readers have it."""
    entries = F.map_entries(pairs)

    def is_last(entry: Column, i: Column) -> Column:
        return ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == entry["key"])

    twice = F.size(F.array_distinct(F.map_keys(pairs))) < F.size(pairs)
    return F.when(twice, F.map_from_entries(F.filter(entries, is_last))).otherwise(pairs)
