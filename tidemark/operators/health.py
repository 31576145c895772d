"""Findings and notes on a tenant's deliveries, each rule as one DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.contract import CLOSED_VALUES, MARTS, SOURCE_COLUMNS, SOURCES
from tidemark.functions.names import batch_ranges
from tidemark.functions.values import adapted, reason_codes
from tidemark.operators.coverage import batch_status, mart_windows, window_days


def batch_health(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each manifest batch, its status and, when quarantined, the codes of its last attempt."""
    codes = F.when(F.col("status") == "quarantined", reason_codes(F.col("last_reasons")))
    return batch_status(manifest, ledger).select(
        "tenant_id", "source", "batch_no", "path", "covers_to", "status", codes.alias("reason_codes"))


def conflicting_redelivery(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Loaded batches with a later attempt quarantined as batch_conflict, and that last attempt's codes."""
    status = batch_status(manifest, ledger).filter("status = 'loaded'")
    later = (
        ledger.filter("status = 'quarantined'")
        .filter(F.array_contains(reason_codes(F.col("reasons")), "batch_conflict"))
        .select("tenant_id", "source", "batch_no", "batch_file_id", "reasons")
        .join(status, ["tenant_id", "source", "batch_no"])
        .filter("batch_file_id > loaded_id")
    )
    return later.groupBy("tenant_id", "source", "batch_no", "path", "covers_to").agg(
        reason_codes(F.max_by("reasons", "batch_file_id")).alias("reason_codes"))


def freshness(manifest: DataFrame, ledger: DataFrame, configured: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per configured source with manifest entries: through which day it is loaded and expected.

    `configured` has (tenant_id, source). `as_of` defaults to the tenant's latest covers_to.
    """
    latest = manifest.groupBy("tenant_id").agg(F.max("covers_to").alias("as_of"))
    if as_of is not None:
        latest = latest.select("tenant_id", F.lit(as_of).alias("as_of"))
    loaded = batch_status(manifest, ledger).groupBy("tenant_id", "source").agg(
        F.max(F.when(F.col("status") == "loaded", F.col("covers_to"))).alias("fresh_through"))
    return configured.join(loaded, ["tenant_id", "source"]).join(latest, "tenant_id")


def stale_sources(fresh: DataFrame) -> DataFrame:
    return fresh.filter("fresh_through IS NULL OR fresh_through < as_of")


def no_manifest_entries(manifest: DataFrame, configured: DataFrame) -> DataFrame:
    return configured.join(manifest, ["tenant_id", "source"], "left_anti")


def source_not_configured(manifest: DataFrame, configured: DataFrame) -> DataFrame:
    return manifest.select("tenant_id", "source").distinct().join(configured, ["tenant_id", "source"], "left_anti")


def invalid_row_findings(current_invalid: DataFrame) -> DataFrame:
    return current_invalid.groupBy("tenant_id", "source", "column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct("batch_no", "line_no")).alias("first")
    ).select("tenant_id", "source", "column_name", "rows",
             F.col("first.batch_no").alias("first_batch"), F.col("first.line_no").alias("first_line"))


def published_incomplete(reported: DataFrame, windows: DataFrame) -> DataFrame:
    """Reported keys inside the window of a batch that has not loaded, per window and mart."""
    days = window_days(mart_windows(windows))
    return days.join(reported.select("tenant_id", "mart", "day"), ["tenant_id", "mart", "day"]).groupBy(
        "tenant_id", "mart", "source", "batch_no", "path", "covers_from", "covers_to", "status"
    ).agg(F.count(F.lit(1)).alias("keys"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def alias_notes(ledger: DataFrame) -> DataFrame:
    """Per source and header read through a declared alias, the loaded batches that used it."""
    used = ledger.filter("status = 'loaded'").select(
        "tenant_id", "source", "batch_no", "batch_file_id", F.explode(adapted(F.col("columns"))).alias("header", "column_name"))
    keys = ["tenant_id", "source", "header", "column_name"]
    first = used.groupBy(*keys).agg(F.min(F.struct("batch_no", "batch_file_id")).alias("first_seen"))
    return batch_ranges(used, keys).join(first, keys)


# ---------------------------------------------------------------------------
# The report lines, word for word.
# ---------------------------------------------------------------------------
LINES = {
    "not_received": "not_received: %s/batch %s (%s, covers through %s)",
    "quarantined": "quarantined: %s/batch %s (%s)",
    "conflicting_redelivery": (
        "conflicting_redelivery: %s/batch %s is loaded, but a later delivery with different content "
        "was quarantined (%s)"
    ),
    "stale": "stale: %s loaded through %s, expected %s",
    "no_manifest_entries": "no_manifest_entries: %s is configured but the manifest lists no batch for it",
    "source_not_configured": "source_not_configured: the manifest lists %s, which this tenant has not configured",
    "invalid_rows": "invalid_rows: %s.%s %s (first: batch %s line %s)",
    "uncounted_values": "uncounted_values: %s.%s %s, not one of %s",
    "published_incomplete": (
        "published_incomplete: %s has %s %s inside %s/batch %s (covers %s to %s), which has not loaded (%s)"
    ),
    "declared_alias": 'note: %s %s read header "%s" as %s (declared alias)',
    "superseded_invalid_rows": "note: %s.%s %s superseded by a later batch",
    "summary": "%s: %s (%s/%s batches loaded, as of %s)",
}
# ---------------------------------------------------------------------------


def plural(count, word: str):
    """`1 row`, `2 rows`."""
    return F.concat(count.cast("string"), F.lit(f" {word}"), F.when(count == 1, F.lit("")).otherwise(F.lit("s")))


def position(column: str, names: list[str]):
    return F.array_position(F.array(*map(F.lit, names)), F.col(column)).cast("int")


def column_position():
    """Where a column stands among its source's columns."""
    rank = F.lit(0)
    for source, columns in SOURCE_COLUMNS.items():
        rank = F.when(F.col("source") == source, position("column_name", columns)).otherwise(rank)
    return rank


def _finding(df: DataFrame, kind: str, stage: int, order: list, *values) -> DataFrame:
    """One text line per row; (stage, order) reproduces the order findings are reported in."""
    ranks = [*order, F.lit(0), F.lit(0), F.lit(0)][:3]
    return df.select(
        "tenant_id", F.lit(kind).alias("kind"), F.format_string(LINES[kind], *[v.cast("string") for v in values]).alias("line"),
        F.struct(F.lit(stage).alias("stage"), *[r.cast("bigint").alias(f"o{i}") for i, r in enumerate(ranks)]).alias("rank"))


def findings(
    manifest: DataFrame, ledger: DataFrame, configured: DataFrame, windows: DataFrame, reported: DataFrame,
    current_invalid: DataFrame, uncounted: DataFrame, as_of: str | None = None,
) -> DataFrame:
    """All findings of all tenants with the line to report."""
    src, batch = position("source", SOURCES), F.col("batch_no")
    codes = F.array_join("reason_codes", ", ")
    batches = batch_health(manifest, ledger)
    rows = [
        _finding(batches.filter("status = 'not_received'"), "not_received", 1, [src, batch],
                 F.col("source"), batch, F.col("path"), F.col("covers_to")),
        _finding(batches.filter("status = 'quarantined'"), "quarantined", 1, [src, batch],
                 F.col("source"), batch, F.when(codes == "", F.lit("no reasons recorded")).otherwise(codes)),
        _finding(conflicting_redelivery(manifest, ledger), "conflicting_redelivery", 1, [src, batch],
                 F.col("source"), batch, codes),
        _finding(stale_sources(freshness(manifest, ledger, configured, as_of)), "stale", 2, [src],
                 F.col("source"), F.coalesce("fresh_through", F.lit("nothing")), F.col("as_of")),
        _finding(no_manifest_entries(manifest, configured), "no_manifest_entries", 2, [src], F.col("source")),
        _finding(source_not_configured(manifest, configured), "source_not_configured", 3, [src], F.col("source")),
        _finding(
            published_incomplete(reported, windows), "published_incomplete", 4, [src, batch, position("mart", list(MARTS))],
            F.col("mart"), plural(F.col("keys"), "published key"),
            F.when(F.col("first_day") == F.col("last_day"), F.concat(F.lit("on "), F.col("first_day").cast("string")))
            .otherwise(F.concat(F.lit("from "), F.col("first_day").cast("string"), F.lit(" to "), F.col("last_day").cast("string"))),
            F.col("source"), batch, F.col("covers_from"), F.col("covers_to"), F.col("status")),
    ]
    column_rank = column_position()
    rows.append(_finding(
        invalid_row_findings(current_invalid), "invalid_rows", 5, [src, column_rank],
        F.col("source"), F.col("column_name"), plural(F.col("rows"), "row"), F.col("first_batch"), F.col("first_line")))
    each = F.struct((-F.col("rows")).alias("n"), F.col("value").alias("v"),
                    F.concat(F.lit('"'), F.col("value"), F.lit('" '), plural(F.col("rows"), "row")).alias("t"))
    listed = uncounted.groupBy("tenant_id", "source", "column_name").agg(F.array_sort(F.collect_list(each)).alias("vs"))
    allowed = F.lit("")
    for (source, column), values in CLOSED_VALUES.items():
        here = (F.col("source") == source) & (F.col("column_name") == column)
        allowed = F.when(here, F.lit(", ".join(values))).otherwise(allowed)
    rows.append(_finding(
        listed, "uncounted_values", 6, [src, column_rank], F.col("source"), F.col("column_name"),
        F.array_join(F.transform("vs", lambda v: v["t"]), ", "), allowed))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def notes(ledger: DataFrame, superseded: DataFrame) -> DataFrame:
    """Things worth knowing that never count as a problem."""
    src = position("source", SOURCES)
    declared = _finding(
        alias_notes(ledger), "declared_alias", 7, [src, F.col("first_seen.batch_no"), F.col("first_seen.batch_file_id")],
        F.col("source"), F.col("batches"), F.col("header"), F.col("column_name"))
    replaced = _finding(
        superseded, "superseded_invalid_rows", 8, [src, column_position()], F.col("source"), F.col("column_name"),
        plural(F.col("rows"), "invalid row"))
    return declared.unionByName(replaced)


def report_lines(
    tenants: DataFrame, manifest: DataFrame, ledger: DataFrame, found: DataFrame, noted: DataFrame, as_of: str | None = None,
) -> DataFrame:
    """The health report as text: a summary line per tenant, then its findings and notes."""
    counts = batch_health(manifest, ledger).groupBy("tenant_id").agg(
        F.count_if(F.col("status") == "loaded").alias("loaded"), F.count(F.lit(1)).alias("listed"),
        F.max("covers_to").alias("last"))
    problems = found.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("n"))
    expected = F.lit(as_of) if as_of is not None else F.coalesce("last", F.lit("n/a"))
    state = F.when(F.col("n").isNull(), F.lit("healthy")).otherwise(plural(F.col("n"), "finding"))
    head = _finding(
        tenants.select("tenant_id").join(counts, "tenant_id", "left").join(problems, "tenant_id", "left"), "summary", 0, [],
        F.col("tenant_id"), state, F.coalesce("loaded", F.lit(0)), F.coalesce("listed", F.lit(0)), expected)
    body = found.unionByName(noted).withColumn("line", F.concat(F.lit("  "), F.col("line")))
    return head.unionByName(body).orderBy("tenant_id", "rank", "line").select("tenant_id", "kind", "line")


def exit_status(found: DataFrame) -> int:
    """2 when any tenant has a finding, else 0; notes never count."""
    return 0 if found.isEmpty() else 2
