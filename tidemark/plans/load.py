"""Loading a delivery: every manifest file is loaded once, quarantined whole, skipped or missing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.contract import REASONS_TYPE, SOURCE_FORMAT
from tidemark.functions.values import adapted, cap_reasons, reason
from tidemark.operators.headers import header_rules, resolve_headers
from tidemark.operators.replay import classify_replays, duplicate_reason, first_of_content
from tidemark.plans.store import Store
from tidemark.session import cut, listed
from tidemark.sources import csv_files, ndjson_files
from tidemark.sources.lines import MISSING, hash_files, number_lines, scan_lines
from tidemark.sources.paths import base_name, inside, normal
from tidemark.sources.tenants import Control


@dataclass(frozen=True)
class Parsed:
    """What parsing says of each file, and the records of the files without a reason."""

    verdicts: DataFrame  # file, reasons (NULL when fine), columns, row_count
    records: DataFrame  # file, line_no, payload


def located(manifest: DataFrame, control: Control, root: str, delivery_root: str) -> DataFrame:
    """Entries of configured tenants with the file each names and whether it is inside its tenant's folder.

    Entries of other tenants are left out.
    """
    at = F.when(F.startswith("path", F.lit("/")), F.col("path")).otherwise(F.concat_ws("/", F.lit(delivery_root), "path"))
    here = manifest.join(control.tenant.select("tenant_id", "fixtures_dir"), "tenant_id")
    here = here.withColumn("file", normal(at)).withColumn("folder", normal(F.concat_ws("/", F.lit(root), "fixtures_dir")))
    return here.withColumn("is_inside", inside(F.col("folder"), F.col("file")))


def _file_problem(files: DataFrame, stats: DataFrame) -> tuple[DataFrame, Column]:
    """Files with their line statistics, and the reason that comes before any look at the contents."""
    with_stats = files.join(stats, "file", "left")
    problem = (
        F.when(~F.col("utf8"), reason("invalid_encoding", "file is not valid UTF-8"))
        .when(F.coalesce("last_line", F.lit(0)) == 0, reason("empty_file", "file has no content"))
    )
    return with_stats, problem


def parse_csv(files: DataFrame, lines: DataFrame, rules: DataFrame) -> Parsed:
    """`files` has (file, tenant_id, source); `lines` is the physical lines of exactly those files."""
    numbered = number_lines(lines)
    checked = cut(csv_files.check_lines(numbered.lines), "checked")
    shapes = cut(csv_files.record_shapes(checked), "shapes")  # read three times; records over lines are found once
    shape = csv_files.shape_reasons(shapes)
    counts = shapes.groupBy("file").agg((F.count(F.lit(1)) - 1).alias("row_count"))
    with_stats, early = _file_problem(files, numbered.files)
    sound = with_stats.filter(early.isNull()).select("file").join(shape, "file", "left_anti")
    # Records are only put together where the whole file has the right shape.
    fit = checked.join(sound, "file", "left_semi")
    texts = csv_files.record_texts(fit)
    # A header is put together from the lines of the first record, not from a pass over all records.
    first = shapes.filter("record = 1").select("file", F.col("end_line").alias("_end"))
    headers = cut(csv_files.headers(csv_files.record_texts(fit.join(first, "file").filter("line_no <= _end").drop("_end"))), "headers")
    resolved = resolve_headers(files.select("file", "tenant_id", "source").join(headers, "file"), rules)
    per_file = (
        with_stats.join(shape, "file", "left").join(counts, "file", "left")
        .join(resolved.select("file", "columns", F.col("reasons").alias("header_reasons")), "file", "left")
    )
    reasons = (
        F.when(early.isNotNull(), F.array(early).cast(REASONS_TYPE))
        .when(F.col("reason").isNotNull(), F.array("reason").cast(REASONS_TYPE))
        .when(F.size("header_reasons") > 0, cap_reasons(F.col("header_reasons")))
    )
    verdicts = cut(per_file.select("file", reasons.alias("reasons"), "columns", "row_count"), "csv_verdicts")
    good = verdicts.filter("reasons IS NULL").select("file")
    return Parsed(verdicts, csv_files.payloads(texts, headers.join(good, "file", "left_semi")))


def parse_ndjson(files: DataFrame, lines: DataFrame, rules: DataFrame) -> Parsed:
    numbered = number_lines(lines)
    checked = cut(ndjson_files.check_lines(numbered.lines), "checked")
    sets = files.select("file", "tenant_id", "source").join(ndjson_files.key_sets(checked), "file")
    resolved = cut(resolve_headers(sets, rules), "key_sets")
    with_stats, early = _file_problem(files, numbered.files)
    listed = ndjson_files.file_reasons(ndjson_files.line_reasons(checked, resolved))
    per_file = with_stats.join(listed, "file", "left").join(ndjson_files.file_columns(resolved), "file", "left")
    reasons = F.when(early.isNotNull(), F.array(early).cast(REASONS_TYPE)).otherwise(F.col("reasons"))
    verdicts = cut(
        per_file.select("file", reasons.alias("reasons"), "columns", F.col("last_line").alias("row_count")), "ndjson_verdicts")
    good = verdicts.filter("reasons IS NULL").select("file")
    return Parsed(verdicts, ndjson_files.payloads(checked.join(good, "file", "left_semi")))


def parse_files(spark: SparkSession, files: DataFrame, rules: DataFrame) -> Parsed:
    """Parse files of both formats. File names (not contents) pass through the driver, as in any scan."""
    parts = []
    for form, parse in (("csv", parse_csv), ("ndjson", parse_ndjson)):
        these = files.filter(F.col("source").isin([s for s, f in SOURCE_FORMAT.items() if f == form]))
        paths = [row.file for row in these.select("file").collect()]
        if paths:
            parts.append(parse(these, scan_lines(spark, paths), rules))
    if not parts:
        return Parsed(
            spark.createDataFrame([], f"file string, reasons {REASONS_TYPE}, columns map<string,string>, row_count bigint"),
            spark.createDataFrame([], "file string, line_no bigint, payload map<string,string>"))
    verdicts, records = parts[0].verdicts, parts[0].records
    for more in parts[1:]:
        verdicts, records = verdicts.unionByName(more.verdicts), records.unionByName(more.records)
    return Parsed(verdicts, records)


def _with_ids(files: DataFrame, store: Store) -> DataFrame:
    """Number this load's files upwards in (tenant, source, batch) order.

    The high half is claimed by this load alone, so a number is never used twice: raw rows of a crashed load
    never come to belong to a later one. The low half is the place in the order, counted per partition.
    """
    mark = store.claim(store.max_id("ledger", "batch_file_id") >> 32)
    ordered = files.orderBy("tenant_id", "source", "batch_no").withColumn("_part", F.spark_partition_id())
    ordered = cut(ordered, "ordered")
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside_part = F.row_number().over(Window.partitionBy("_part").orderBy("tenant_id", "source", "batch_no"))
    numbered = ordered.withColumn("_row", inside_part).join(sizes.select("_part", before.alias("_before")), "_part")
    return numbered.withColumn("batch_file_id", F.lit(mark << 32) + F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def load(
    spark: SparkSession, store: Store, control: Control, manifest: DataFrame, root: str, delivery_root: str | None = None,
) -> DataFrame:
    """Load every manifest file of the configured tenants; one result row per entry.

    Raw rows are written first and ledger rows last. Readers reach raw rows only through a loaded ledger
    row, so a load that dies in between has loaded nothing and can simply be run again.
    """
    delivery_root = delivery_root or f"{root.rstrip('/')}/fixtures"
    entries = located(manifest, control, root, delivery_root)
    outside = listed(entries.filter("NOT is_inside").select("tenant_id", "source", "batch_no", F.concat(
        F.lit("Manifest entry "), F.col("tenant_id"), F.lit("/"), F.col("source"), F.lit("/batch "), F.col("batch_no"), F.lit(' path "'),
        F.col("path"), F.lit('" is outside '), F.col("fixtures_dir")).alias("text")))
    if outside:
        raise ValueError("; ".join(outside))

    columns = ["tenant_id", "source", "batch_no", "path"]
    hidden = F.when(base_name(F.col("file")).rlike("^[._]"), F.lit("names that begin with . or _ are not read"))
    found = cut(entries.join(hash_files(entries), "file").withColumn(
        "error", F.when(F.coalesce("error", F.lit("")) == MISSING, F.col("error")).otherwise(F.coalesce("error", hidden))), "found")
    # A file that cannot be read fails alone; later files of its tenant wait for the next load, other tenants carry on.
    failed = found.filter(F.col("error") != MISSING).groupBy("tenant_id").agg(F.min(F.struct("source", "batch_no")).alias("first_failed"))
    found = found.join(failed, "tenant_id", "left").withColumn("held_up", F.coalesce(F.struct("source", "batch_no") > F.col("first_failed"), F.lit(False)))
    found = cut(found, "found")
    delivered = found.filter("error IS NULL AND NOT held_up").select(*columns, "file", "sha256")
    stopped = found.filter(f"held_up OR error <> '{MISSING}'").select(
        *columns, F.when(F.col("held_up"), F.lit("blocked")).otherwise(F.lit("failed")).alias("status"),
        F.when(~F.col("held_up"), F.array(reason("failed", F.col("error")))).cast(REASONS_TYPE).alias("reasons"))
    gone = found.filter(f"error = '{MISSING}' AND NOT held_up").select(*columns, F.lit("missing").alias("status"))
    files = cut(_with_ids(classify_replays(delivered, store.read("ledger"), control.configured), store), "files")

    to_parse = files.filter("verdict = 'parse'").select("file", "tenant_id", "source", "batch_no", "sha256")
    parsed = parse_files(spark, to_parse, header_rules(spark, control.alias, control.configured))
    fine = to_parse.join(parsed.verdicts.filter("reasons IS NULL").select("file"), "file", "left_semi")
    repeats = first_of_content(fine).filter("first_batch < batch_no").select("file", "first_batch")
    why = F.coalesce(
        F.col("reasons"), F.col("parse_reasons"),
        F.when(F.col("first_batch").isNotNull(), F.array(duplicate_reason(F.col("first_batch")))).cast(REASONS_TYPE))
    status = (
        F.when(F.col("verdict") == "skipped", F.lit("skipped"))
        .when(F.col("why").isNotNull(), F.lit("quarantined")).otherwise(F.lit("loaded")))
    judged = (
        files.join(parsed.verdicts.withColumnRenamed("reasons", "parse_reasons"), "file", "left")
        .join(repeats, "file", "left").withColumn("why", why).withColumn("status", status)
    )
    is_loaded = F.col("status") == "loaded"
    final = cut(judged.select(
        *columns, "file", "batch_file_id", "sha256", "status", F.col("why").alias("reasons"),
        F.when(is_loaded, F.col("row_count")).when(F.col("status") == "skipped", F.col("earlier_rows")).alias("row_count"),
        F.when(is_loaded, F.col("columns")).alias("columns")), "judged")

    loaded = final.filter("status = 'loaded'").select("file", "tenant_id", "source", "batch_file_id")
    store.append("raw", parsed.records.join(loaded, "file").withColumn("line_no", F.col("line_no").cast("int")))
    store.append("ledger", final.filter("status <> 'skipped'").withColumn("loaded_at", F.current_timestamp()))

    done = final.select(*columns, "status", "row_count", "reasons", adapted(F.col("columns")).alias("adapted"))
    return done.unionByName(stopped, allowMissingColumns=True).unionByName(gone, allowMissingColumns=True)


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
