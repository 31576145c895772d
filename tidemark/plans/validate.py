"""Onboarding: every mistake in configuration, manifest and files that a load would trip over, without loading."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.contract import CLOSED_VALUES, ISO_DATE, MAPPED_COLUMNS, SOURCES
from tidemark.functions.names import batch_gaps, best_match, gap_texts, near_misses
from tidemark.operators import onboarding
from tidemark.operators.headers import header_rules
from tidemark.operators.health import no_manifest_entries, plural, position, source_not_configured
from tidemark.operators.staging import canonical_text
from tidemark.plans.load import located, parse_files
from tidemark.session import cut, small_frame
from tidemark.sources.lines import list_files
from tidemark.sources.manifest import manifest_problems, scan_manifest
from tidemark.sources.paths import base_name, normal, parent
from tidemark.sources.tenants import config_problems, control_of, scan_tenants

# ---------------------------------------------------------------------------
# Severity and message of every issue, word for word.
# ---------------------------------------------------------------------------
ISSUES = {
    "no_tenant_file": ("error", "tenants/%s.json does not exist%s"),
    "invalid_json": ("error", "tenants/%s.json: %s"),
    "invalid_config": ("error", "tenants/%s.json %s: %s"),
    "id_mismatch": ("error", "tenants/%s.json %s"),
    "invalid_manifest": ("error", "batches.%s: %s"),
    "skipped": ("info", "manifest entries and files were not checked until the manifest is valid"),
    "unreadable": ("error", "%s: %s; manifest entries and files were not checked"),
    "unknown_tenant": ("error", '%s for tenant "%s", which has no tenants/%s.json%s'),
    "invalid_date": ("error", '%s/batch %s %s "%s" is not a calendar date'),
    "no_manifest_entries": ("warning", "%s is configured but the manifest lists no batch for it"),
    "source_not_configured": (
        "error", "the manifest lists %s, which this tenant has not configured: its files would be quarantined"),
    "batch_gap": ("warning", "%s manifest skips %s %s"),
    "path_outside": ("error", '%s/batch %s "%s" is outside %s: the load would stop before any file'),
    "no_fixtures_dir": ("warning", "fixturesDir %s does not exist"),
    "not_on_disk": ("warning", '%s/batch %s "%s" not on disk: not delivered yet, or a path typo?%s'),
    "not_in_manifest": ("warning", "%s on disk but not in the manifest: it will not load"),
    "would_be_quarantined": ("error", '%s/batch %s "%s" would be quarantined: %s'),
    "unused_value_map": ("warning", "%s.%s has a value map, but staging maps only %s of %s"),
    "uncounted_values": ("error", "%s.%s %s would not be counted: not one of %s"),
    "values": ("info", "%s.%s %s"),
    "unmapped_values": ("warning", "%s.%s %s not in the value map: passed through unchanged"),
    "channel_mismatch": ("warning", "%s %s not in %s: %s"),
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Validation:
    issues: DataFrame  # scope, severity, code, message, in `rank` order

    def totals(self) -> DataFrame:
        return self.issues.groupBy("scope", "severity").agg(F.count(F.lit(1)).alias("issues"))

    def exit_status(self) -> int:
        return 0 if self.issues.filter("severity = 'error'").isEmpty() else 2


def _issue(df: DataFrame, code: str, stage: int, order: list[Column], *values: Column, scope: str = "tenant_id") -> DataFrame:
    severity, template = ISSUES[code]
    ranks = [o.cast("string") for o in order] + [F.lit("")] * 3
    text = F.format_string(template, *[v.cast("string") for v in values]) if values else F.lit(template)
    return df.select(
        F.col(scope).alias("scope"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), text.alias("message"),
        F.struct(F.lit(stage).alias("stage"), *[r.alias(f"o{i}") for i, r in enumerate(ranks[:3])]).alias("rank"))


def _padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), 12, "0")


def _meant(suggestion: Column) -> Column:
    return F.when(suggestion.isNull(), F.lit("")).otherwise(F.concat(F.lit(' (did you mean "'), suggestion, F.lit('"?)')))


def _config_issues(spark: SparkSession, scanned: DataFrame, ids: list[str]) -> list[DataFrame]:
    problems = cut(config_problems(scanned), "config_problems")
    out = []
    for code in ("invalid_json", "invalid_config", "id_mismatch"):
        parts = ["path", "message"] if code == "invalid_config" else ["message"]
        rows = problems.filter(F.col("code") == code)
        out.append(_issue(rows, code, 1, [F.col("path")], F.col("tenant_id"), *[F.col(p) for p in parts]))
    if ids:
        asked = small_frame(spark, [(i, "tenants") for i in sorted(set(ids))], "name string, folder string")
        known = scanned.select(F.col("file_id").alias("candidate"), F.lit("tenants").alias("folder"))
        absent = asked.join(known, F.col("name") == F.col("candidate"), "left_anti")
        meant = best_match(near_misses(absent, known, ["folder"]), ["folder"])
        rows = absent.join(meant, ["folder", "name"], "left").withColumn("tenant_id", F.col("name"))
        out.append(_issue(rows, "no_tenant_file", 0, [], F.col("name"), _meant(F.col("suggestion"))))
    return out


def _entry_issues(entries: DataFrame, configured: DataFrame) -> list[DataFrame]:
    dates = entries.select("*", F.explode(F.array(
        F.struct(F.lit("covers_from").alias("field"), F.col("covers_from").alias("text")),
        F.struct(F.lit("covers_to").alias("field"), F.col("covers_to").alias("text")))).alias("d"))
    bad = ~F.coalesce(F.col("d.text").rlike(ISO_DATE) & F.col("d.text").try_cast("date").isNotNull(), F.lit(False))
    src = position("source", SOURCES)
    by = ["tenant_id", "source"]
    gaps = gap_texts(batch_gaps(entries, by), by)
    return [
        _issue(dates.filter(bad), "invalid_date", 2, [F.col("source"), _padded(F.col("batch_no")), F.col("d.field")],
               F.col("source"), F.col("batch_no"), F.col("d.field"), F.col("d.text")),
        _issue(no_manifest_entries(entries, configured), "no_manifest_entries", 3, [src, F.lit(0)], F.col("source")),
        _issue(source_not_configured(entries, configured), "source_not_configured", 3, [src, F.lit(0)], F.col("source")),
        _issue(gaps, "batch_gap", 3, [src, F.lit(1)], F.col("source"),
               F.when(F.col("n") == 1, F.lit("batch")).otherwise(F.lit("batches")), F.col("batches")),
    ]


def _file_issues(here: DataFrame, listing: DataFrame, tenants: DataFrame, root: str) -> list[DataFrame]:
    at = [F.col("source"), _padded(F.col("batch_no"))]
    name = [F.col("source"), F.col("batch_no"), F.col("path")]
    outside = here.filter("NOT is_inside")
    absent = here.filter("is_inside").join(listing, "file", "left_anti")
    unlisted = listing.join(here.select("file").distinct(), "file", "left_anti")
    typos = near_misses(
        absent.select(parent(F.col("file")).alias("folder_of"), base_name(F.col("file")).alias("name")),
        unlisted.select(parent(F.col("file")).alias("folder_of"), base_name(F.col("file")).alias("candidate")), ["folder_of"])
    similar = typos.groupBy("folder_of", "name").agg(F.array_sort(F.collect_list(F.struct("distance", "candidate"))).alias("s"))
    absent = absent.withColumn("folder_of", parent(F.col("file"))).withColumn("name", base_name(F.col("file"))).join(
        similar, ["folder_of", "name"], "left")
    hint = F.when(F.col("s").isNull(), F.lit("")).otherwise(
        F.concat(F.lit(" (similar: "), F.array_join(F.col("s.candidate"), ", "), F.lit(")")))
    source_dirs = tenants.select("tenant_id", "fixtures_dir", F.explode(F.array(*map(F.lit, SOURCES))).alias("source")).withColumn(
        "folder_of", normal(F.concat_ws("/", F.lit(root), "fixtures_dir", "source")))
    visible = unlisted.withColumn("folder_of", parent(F.col("file"))).withColumn("base", base_name(F.col("file"))).filter(
        ~F.startswith("base", F.lit(".")))
    extra = visible.join(source_dirs, "folder_of").withColumn(
        "shown", F.concat_ws("/", "fixtures_dir", "source", "base"))
    folders = tenants.withColumn("folder", normal(F.concat_ws("/", F.lit(root), "fixtures_dir")))
    # A tenant has a folder when some file below it is listed: explode each file's ancestors once.
    parts = F.split("file", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    above = listing.select(F.explode(ancestors).alias("folder")).distinct()
    return [
        _issue(folders.join(above, "folder", "left_anti"), "no_fixtures_dir", 4, [], F.col("fixtures_dir")),
        _issue(outside, "path_outside", 5, at, *name, F.col("fixtures_dir")),
        _issue(absent, "not_on_disk", 5, at, *name, hint),
        _issue(extra, "not_in_manifest", 6, [position("source", SOURCES), F.col("base")], F.col("shown")),
    ]


def _listed(df: DataFrame, text: Column) -> DataFrame:
    """One text per column of its values, most rows first."""
    each = F.struct((-F.col("rows")).alias("n"), F.col("value_order").alias("v"), text.alias("t"))
    return df.groupBy(*onboarding.COLUMN).agg(F.array_sort(F.collect_list(each)).alias("l")).withColumn(
        "text", F.array_join(F.col("l.t"), ", "))


def _value_issues(spark: SparkSession, texts: dict[str, DataFrame], value_map: DataFrame) -> list[DataFrame]:
    tally = cut(onboarding.value_tally(texts), "tally")
    src, name = position("source", SOURCES), [F.col("source"), F.col("column_name")]
    order = [src, F.col("column_name")]
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    row = F.concat(
        quoted(F.col("raw_value")),
        F.when(F.col("value") == F.col("raw_value"), F.lit("")).otherwise(F.concat(F.lit(" (mapped to "), quoted(F.col("value")), F.lit(")"))),
        F.lit(" "), plural(F.col("rows"), "row"))
    allowed = reduce(lambda acc, kv: F.when(
        (F.col("source") == kv[0][0]) & (F.col("column_name") == kv[0][1]), F.lit(", ".join(kv[1]))).otherwise(acc),
        CLOSED_VALUES.items(), F.lit(""))
    mapped = reduce(lambda acc, kv: F.when(
        F.col("source") == kv[0], F.lit(", ".join(f"{kv[0]}.{c}" for c in kv[1]) or "nothing")).otherwise(acc),
        MAPPED_COLUMNS.items(), F.lit("nothing"))
    uncounted = _listed(onboarding.uncounted_raw(tally).withColumn("value_order", F.col("raw_value")), row)
    opened = _listed(onboarding.open_values(tally).withColumn("value_order", F.col("value")),
                     F.concat_ws(" ", "value", "rows"))
    unmapped = _listed(onboarding.unmapped_values(tally, value_map).withColumn("value_order", F.col("raw_value")), row)
    mismatch = onboarding.channel_mismatch(tally).groupBy("tenant_id", "side").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("value")), quoted), ", ").alias("text"))
    revenue = F.col("side") == "revenue"
    return [
        _issue(onboarding.unused_value_maps(value_map), "unused_value_map", 7, order, *name, mapped, F.col("source")),
        _issue(uncounted, "uncounted_values", 8, [F.col("source"), F.col("column_name"), F.lit(0)], *name, F.col("text"), allowed),
        _issue(opened, "values", 8, [F.col("source"), F.col("column_name"), F.lit(0)], *name, F.col("text")),
        _issue(unmapped, "unmapped_values", 8, [F.col("source"), F.col("column_name"), F.lit(1)], *name, F.col("text")),
        _issue(mismatch, "channel_mismatch", 9, [F.col("side")],
               F.when(revenue, F.lit("orders.channel")).otherwise(F.lit("ad_spend.platform")), F.col("text"),
               F.when(revenue, F.lit("ad_spend.platform")).otherwise(F.lit("orders.channel")),
               F.when(revenue, F.lit("revenue with no spend in channel performance")).otherwise(
                   F.lit("spend with no revenue in channel performance"))),
    ]


def validate(spark: SparkSession, root: str, ids: list[str] | None = None, manifest_path: str | None = None) -> Validation:
    """Check tenants/*.json, fixtures/manifest.json and every listed file below `root`. Reads files only.

    `ids` limits the tenants reported. Issues are in check order within a scope.
    """
    root = root.rstrip("/")
    scanned = scan_tenants(spark, f"{root}/tenants")
    issues = _config_issues(spark, scanned, ids or [])
    wanted = (lambda df, c: df.filter(F.col(c).isin(ids))) if ids else (lambda df, c: df)
    broken = config_problems(scanned).select(F.col("tenant_id").alias("file_id")).distinct()
    control = control_of(cut(wanted(scanned, "file_id").join(broken, "file_id", "left_anti"), "valid_tenants"))
    where = manifest_path or f"{root}/fixtures/manifest.json"
    scope = where[len(root) + 1:] if where.startswith(root + "/") else where

    def finish(parts: list[DataFrame]) -> Validation:
        every = reduce(DataFrame.unionByName, parts)
        if ids:
            every = every.filter(F.col("scope").isin([*ids, scope]))
        return Validation(cut(every, "issues"))

    try:
        entries = cut(scan_manifest(spark, where), "entries")
        problems = cut(manifest_problems(entries), "manifest_problems")
    except PySparkException as error:  # a manifest that is no JSON, or not there at all; any other failure is ours
        if not any(kind in str(error) for kind in ("PATH_NOT_FOUND", "MALFORMED_RECORD_IN_PARSING")):
            raise
        code, (severity, template) = "unreadable", ISSUES["unreadable"]
        kind = "no readable JSON" if "PATH_NOT_FOUND" not in str(error) else "not found"
        one = small_frame(spark, [(scope, template % (scope, kind))], "scope string, text string")
        rank = F.struct(F.lit(-2).alias("stage"), *[F.lit("").alias(f"o{i}") for i in range(3)])
        return finish([*issues, one.select(
            "scope", F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col("text").alias("message"), rank.alias("rank"))])
    at_scope = lambda df: df.withColumn("scope_", F.lit(scope))
    if not problems.isEmpty():
        one = at_scope(small_frame(spark, [(1,)], "n int"))
        return finish([
            *issues,
            _issue(at_scope(problems), "invalid_manifest", -2, [_padded(F.col("position"))], F.col("position"), F.col("message"), scope="scope_"),
            _issue(one, "skipped", -1, [], scope="scope_")])

    entries = entries.withColumn("batch_no", F.col("batch_no").cast("int"))
    known = scanned.select(F.col("file_id").alias("candidate"), F.lit("tenants").alias("folder"))
    unknown = entries.join(scanned, F.col("tenant_id") == F.col("file_id"), "left_anti").groupBy(
        F.col("tenant_id").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("folder", F.lit("tenants"))
    meant = best_match(near_misses(unknown, known, ["folder"]), ["folder"])
    unknown = at_scope(unknown.join(meant, ["folder", "name"], "left"))
    count = F.concat(F.col("n").cast("string"), F.when(F.col("n") == 1, F.lit(" entry")).otherwise(F.lit(" entries")))
    issues.append(_issue(unknown, "unknown_tenant", -1, [F.col("name")], count, F.col("name"), F.col("name"),
                         _meant(F.col("suggestion")), scope="scope_"))

    mine = entries.join(control.tenant.select("tenant_id"), "tenant_id", "left_semi")
    issues += _entry_issues(mine, control.configured)
    listing = cut(list_files(spark, f"{root}/fixtures"), "listing")
    here = cut(located(mine, control, root, f"{root}/fixtures"), "located")
    issues += _file_issues(here, listing, control.tenant, root)

    readable = here.filter("is_inside").join(listing, "file", "left_semi").join(
        control.configured, ["tenant_id", "source"], "left_semi")
    files = cut(readable.select("file", "tenant_id", "source", "batch_no", "path"), "files")
    parsed = parse_files(spark, files, header_rules(spark, control.alias, control.configured))
    held = files.join(parsed.verdicts.filter("reasons IS NOT NULL"), "file")
    each = F.transform("reasons", lambda r: F.concat(
        r["code"], F.when(r["line"].isNull(), F.lit("")).otherwise(F.concat(F.lit(" line "), r["line"].cast("string"))),
        F.lit(" "), r["message"]))
    issues.append(_issue(held, "would_be_quarantined", 5, [F.col("source"), _padded(F.col("batch_no"))],
                         F.col("source"), F.col("batch_no"), F.col("path"), F.array_join(each, "; ")))

    # The loader's raw layer and ledger for these files, without storing them.
    numbered = files.withColumn("batch_file_id", F.xxhash64("file"))
    raw = cut(parsed.records.join(numbered.select("file", "tenant_id", "source", "batch_file_id"), "file"), "raw")
    ledger = cut(
        numbered.join(parsed.verdicts.filter("reasons IS NULL"), "file").withColumn("status", F.lit("loaded")), "ledger")
    texts = {s: canonical_text(raw, ledger, control.value_map, s) for s, columns in MAPPED_COLUMNS.items() if columns}
    issues += _value_issues(spark, texts, control.value_map)
    return finish(issues)


def report_lines(v: Validation) -> DataFrame:
    """A summary line per scope with its issues below it, and a final line of totals."""
    def totals(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(
            F.count_if(F.col("severity") == "error").alias("e"), F.count_if(F.col("severity") == "warning").alias("w"))

    counts = F.concat(plural(F.col("e"), "error"), F.lit(", "), plural(F.col("w"), "warning"))
    heads = totals(v.issues, "scope").select(
        F.lit(0).alias("part"), "scope", F.lit(None).cast(v.issues.schema["rank"].dataType).alias("rank"),
        F.concat("scope", F.lit(": "), counts).alias("line"))
    body = v.issues.select(F.lit(0).alias("part"), "scope", "rank", F.concat(
        F.lit("  "), "severity", F.lit(" "), "code", F.lit(": "), "message").alias("line"))
    end = totals(v.issues).select(
        F.lit(1).alias("part"), F.lit("").alias("scope"), F.lit(None).cast(v.issues.schema["rank"].dataType).alias("rank"),
        F.concat(F.lit("total: "), counts).alias("line"))
    first = F.when(F.col("scope").rlike("manifest"), F.lit(0)).otherwise(F.lit(1))
    return heads.unionByName(body).unionByName(end).orderBy(
        "part", first, "scope", F.asc_nulls_first("rank"), "line").select("scope", "line")
