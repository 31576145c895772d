"""One query per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import deliveries as d
from tidemark.contract import MARTS, SOURCE_COLUMNS, SOURCE_FORMAT
from tidemark.functions import casts, names
from tidemark.functions.values import adapted, column_value as read_value, map_values, readers, reason
from tidemark.operators import control, coverage, health, marts, onboarding, publishing, quality, replay, scope, staging
from tidemark.operators.headers import header_rules, resolve_headers
from tidemark.plans.load import load, parse_csv, parse_ndjson
from tidemark.plans.store import Store
from tidemark.session import cut, cut_all, shared_folder, small_frame
from tidemark.sources import csv_files, lines
from tidemark.sources.tenants import Control

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _staged(spark: SparkSession, sf_dir: str, source: str, ledger: DataFrame | None = None) -> DataFrame:
    lg = ledger if ledger is not None else d.ledger(spark)
    vm = d.value_map(spark)
    if source == "refunds":
        keys = staging.order_keys(d.raw_orders(spark, sf_dir), lg, d.WIDTH)
        return staging.refunds(d.raw_refunds(spark, sf_dir), lg, vm, d.WIDTH, known_orders=keys)
    return staging.STAGING[source](d.RAW[source](spark, sf_dir), lg, vm, d.WIDTH)


def _staged_for_marts(spark: SparkSession, sf_dir: str, ledgers: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    """What marts read of the staging relations of each ledger; lines are read once for all of them."""
    runs, lg, vm = list(ledgers), staging.ledger_of_runs(ledgers), d.value_map(spark)
    lg = cut(lg, "ledger")
    drop = {"orders": [], "email_events": ["event_id"], "ad_spend": ["campaign_id"]}
    staged = cut_all({
        s: staging.STAGING[s](d.RAW[s](spark, sf_dir), lg, vm, d.WIDTH, runs=runs).drop("batch_no", "line_no", *unread)
        for s, unread in drop.items()})
    known = staged["orders"].select("tenant_id", "order_id", *runs)
    staged["refunds"] = cut(staging.refunds(d.raw_refunds(spark, sf_dir), lg, vm, d.WIDTH, known, runs).drop("refund_id"), "refunds")
    return {run: staging.of_run(staged, run, runs) for run in runs}


def _cut_staged(spark: SparkSession, sf_dir: str, ledger: DataFrame | None = None) -> dict[str, DataFrame]:
    lg = ledger if ledger is not None else d.ledger(spark)
    return _staged_for_marts(spark, sf_dir, {"all": lg})["all"]


def _mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    staged = {feed.source: _staged(spark, sf_dir, feed.source) for feed in MARTS[name].feeds}
    return marts.build(staged, d.tenants(spark), [name])[name]


# --- staging -------------------------------------------------------------------------------------------


@query
def staging_orders(spark, sf_dir):
    df = _doubles(_staged(spark, sf_dir, "orders"), "gross")
    return df.withColumn("created_at", F.unix_micros("created_at"))


@query
def staging_email_events(spark, sf_dir):
    return _staged(spark, sf_dir, "email_events").withColumn("occurred_at", F.unix_micros("occurred_at"))


@query
def staging_ad_spend(spark, sf_dir):
    return _doubles(_staged(spark, sf_dir, "ad_spend"), "spend")


@query
def staging_refunds(spark, sf_dir):
    df = _doubles(_staged(spark, sf_dir, "refunds"), "amount")
    return df.withColumn("refunded_at", F.unix_micros("refunded_at"))


# --- marts ---------------------------------------------------------------------------------------------


@query
def daily_revenue(spark, sf_dir):
    return _doubles(_mart(spark, sf_dir, "daily_revenue"), "gross", "refunds", "net", "orphan_refund_amount")


@query
def daily_ad_spend(spark, sf_dir):
    return _doubles(_mart(spark, sf_dir, "daily_ad_spend"), "spend")


@query
def daily_email_engagement(spark, sf_dir):
    return _mart(spark, sf_dir, "daily_email_engagement")


@query
def daily_channel_performance(spark, sf_dir):
    return _doubles(_mart(spark, sf_dir, "daily_channel_performance"), "revenue", "spend", "roas")


@query
def reconciliation(spark, sf_dir):
    """Days on which the clients' own order totals differ from the mart (their totals ignore corrections)."""
    theirs = d.table(spark, sf_dir, "orders").groupBy(
        d._tenant("o_orderkey"), F.col("o_orderdate").cast("date").alias("day")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,6)").alias("gross"))
    return _doubles(marts.reconcile(_mart(spark, sf_dir, "daily_revenue"), theirs), "gross", "gross_reported", "difference")


# --- data quality --------------------------------------------------------------------------------------


def _checked(spark, sf_dir):
    return quality.checked_all(d.raw(spark, sf_dir), d.ledger(spark), d.value_map(spark), d.WIDTH)


@query
def invalid_rows(spark, sf_dir):
    return quality.invalid_rows(_checked(spark, sf_dir))


@query
def current_invalid_rows(spark, sf_dir):
    return quality.current_invalid_rows(cut_all(_checked(spark, sf_dir)))


@query
def superseded_invalid_rows(spark, sf_dir):
    checked = cut_all(_checked(spark, sf_dir))
    return quality.superseded_counts(quality.invalid_rows(checked), quality.current_invalid_rows(checked))


@query
def invalid_row_findings(spark, sf_dir):
    return health.invalid_row_findings(quality.current_invalid_rows(cut_all(_checked(spark, sf_dir))))


@query
def uncounted_values(spark, sf_dir):
    return quality.uncounted_values({"email_events": _staged(spark, sf_dir, "email_events")})


# --- publishing ----------------------------------------------------------------------------------------

# The first run saw everything but the redelivered orders and one year of spend; the second sees all but
# two batches that never loaded.
LATE = [("orders", d.REDELIVERY), ("ad_spend", 4)]
NEVER = {("t1", "orders", 7): "quarantined", ("t0", "ad_spend", 6): "not_received", ("t0", "email_events", 3): "quarantined"}


def _first_ledger(spark):
    late = {(t, s, b): "not_received" for t, _, _ in d.TENANTS for s, b in LATE}
    return d.ledger(spark, late)


def _second_ledger(spark):
    return d.ledger(spark, NEVER)


def _windows(spark):
    return coverage.incomplete_windows(d.manifest(spark), _second_ledger(spark))


def _run_files(spark, ledger: DataFrame, run_id: int) -> DataFrame:
    return ledger.filter("status = 'loaded'").select(
        "tenant_id", F.lit(run_id).cast("bigint").alias("run_id"), "batch_file_id", "source")


def _first_run(spark, staged: dict[str, DataFrame]) -> DataFrame:
    """What the first run wrote: version 1 of every key."""
    return publishing.mart_keys(marts.build(staged, d.tenants(spark))).select(
        F.lit(1).cast("bigint").alias("run_id"), "mart", "day", "dims", F.lit(1).alias("version"), "metrics", "tenant_id")


def _published(spark, sf_dir) -> DataFrame:
    return _first_run(spark, _cut_staged(spark, sf_dir, _first_ledger(spark)))


def _second_run(spark, sf_dir):
    staged = _staged_for_marts(spark, sf_dir, {"first": _first_ledger(spark), "second": _second_ledger(spark)})
    first, second = staged["first"], staged["second"]
    keys = cut_all({
        "published": _first_run(spark, first), "current": publishing.mart_keys(marts.build(second, d.tenants(spark)))})
    return second, keys["published"], publishing.classify(keys["current"], keys["published"], _windows(spark))


@query
def incomplete_windows(spark, sf_dir):
    """Batches without a loaded file, per mart they leave open, with the live mart keys inside each window."""
    windows = coverage.mart_windows(_windows(spark))
    built = marts.build(_cut_staged(spark, sf_dir, _second_ledger(spark)), d.tenants(spark))
    keys = publishing.mart_keys(built).select("tenant_id", "mart", "day", F.lit(1).alias("_key"))
    columns = ["tenant_id", "mart", "source", "batch_no", "path", "covers_from", "covers_to", "status"]
    days = coverage.window_days(windows)
    return days.join(keys, ["tenant_id", "mart", "day"], "left").groupBy(*columns).agg(F.count("_key").alias("keys"))


@query
def publish_versions(spark, sf_dir):
    _, _, done = _second_run(spark, sf_dir)
    return publishing.new_versions(done)


@query
def restatements(spark, sf_dir):
    _, _, done = _second_run(spark, sf_dir)
    return done.filter("action = 'restated'").select(*publishing.KEY, "from_version", "to_version", "before", "after")


@query
def tombstones(spark, sf_dir):
    _, _, done = _second_run(spark, sf_dir)
    return done.filter("action = 'tombstone'").select(*publishing.KEY, "from_version", "to_version", "before", "after")


@query
def withheld_keys(spark, sf_dir):
    _, _, done = _second_run(spark, sf_dir)
    return publishing.withheld_keys(done, _windows(spark))


@query
def publish_summary(spark, sf_dir):
    _, _, done = _second_run(spark, sf_dir)
    return publishing.summary(done)


@query
def caused_by(spark, sf_dir):
    staged, _, done = _second_run(spark, sf_dir)
    loaded = _second_ledger(spark).filter("status = 'loaded'")
    found = publishing.causes(
        publishing.changed(done), publishing.lineage(staged), _run_files(spark, _first_ledger(spark), 1), loaded)
    return found.select(*publishing.KEY, "to_version", F.array_join("caused_by", ",").alias("caused_by"))


@query
def reported_metric(spark, sf_dir):
    """What clients see after both runs."""
    _, first, done = _second_run(spark, sf_dir)
    second = publishing.new_versions(done).withColumn("run_id", F.lit(2).cast("bigint"))
    return publishing.reported_metric(first.unionByName(second))


@query
def lineage(spark, sf_dir):
    return publishing.lineage(_cut_staged(spark, sf_dir))


@query
def published_incomplete(spark, sf_dir):
    """Keys of the first run inside windows that are incomplete now."""
    found = health.published_incomplete(publishing.reported_metric(_published(spark, sf_dir)), _windows(spark))
    return found.select("tenant_id", "mart", "source", "batch_no", "status", "keys", "first_day", "last_day")


# --- onboarding ----------------------------------------------------------------------------------------


def _texts(spark, sf_dir):
    return {
        s: staging.canonical_text(d.RAW[s](spark, sf_dir), d.ledger(spark), d.value_map(spark), s, d.WIDTH)
        for s in ("orders", "email_events", "ad_spend")
    }


@query
def value_tally(spark, sf_dir):
    return onboarding.value_tally(_texts(spark, sf_dir))


@query
def unmapped_values(spark, sf_dir):
    return onboarding.unmapped_values(onboarding.value_tally(_texts(spark, sf_dir)), d.value_map(spark))


@query
def channel_mismatch(spark, sf_dir):
    return onboarding.channel_mismatch(cut(onboarding.value_tally(_texts(spark, sf_dir)), "tally"))


@query
def near_misses(spark, sf_dir):
    """Hosts seen only over http that look like a typo of one seen over https."""
    pages = d.table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"), F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"))
    secure = pages.filter("scheme = 'https'").select(F.col("host").alias("candidate"), F.lit("pages").alias("folder")).distinct()
    plain = pages.filter("scheme = 'http'").select(F.col("host").alias("name"), F.lit("pages").alias("folder")).distinct()
    pairs = names.near_misses(plain.join(secure, F.col("name") == F.col("candidate"), "left_anti"), secure, ["folder"])
    return pairs.select("name", "candidate", "distance")


@query
def missing_files(spark, sf_dir):
    """Parts expected among the returns at the deepest discount that never arrived there."""
    returned = d.table(spark, sf_dir, "lineitem").filter(
        "l_returnflag = 'R' AND cast(l_discount AS decimal(4,2)) = 0.10").select(F.col("l_partkey").alias("p_partkey"))
    return d.table(spark, sf_dir, "part").join(returned, "p_partkey", "left_anti").select("p_partkey", "p_name")


def _customer_years(spark, sf_dir):
    """Per order the customer as tenant and the year as batch."""
    return d.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("tenant_id"), F.lit("orders").alias("source"),
        (F.year("o_orderdate") - 1994).alias("batch_no"), "o_orderkey", "o_orderstatus")


@query
def batch_gap(spark, sf_dir):
    by = ["tenant_id", "source"]
    return names.skipped_numbers(names.batch_gaps(_customer_years(spark, sf_dir), by), by)


@query
def batch_ranges(spark, sf_dir):
    return names.batch_ranges(_customer_years(spark, sf_dir), ["tenant_id", "source"])


# --- ledger against manifest: every order is a delivery attempt of its customer's year -----------------


def _year_manifest(spark, sf_dir):
    customers = _customer_years(spark, sf_dir).select("tenant_id", "source").distinct()
    entries = customers.withColumn("batch_no", F.explode(F.sequence(F.lit(1), F.lit(7))))
    year = (F.col("batch_no") + 1994).cast("string")
    return entries.select(
        "*", F.concat_ws("/", "tenant_id", year).alias("path"), F.concat(year, F.lit("-01-01")).alias("covers_from"),
        F.concat(year, F.lit("-12-31")).alias("covers_to"))


def _year_ledger(spark, sf_dir):
    """Filled orders are loads, open ones conflicting redeliveries, pending ones files with wrong headers."""
    status = F.when(F.col("o_orderstatus") == "F", F.lit("loaded")).otherwise(F.lit("quarantined"))
    conflict = F.array(reason("batch_conflict", "conflict"))
    header = F.array(reason("unknown_header", "x"), reason("missing_column", "y"), reason("unknown_header", "z"))
    alias = F.when(F.col("o_orderkey") % 2 == 0, F.lit("total")).otherwise(F.lit("gross"))
    return _customer_years(spark, sf_dir).select(
        "tenant_id", "source", "batch_no", F.col("o_orderkey").alias("batch_file_id"), status.alias("status"),
        F.when(F.col("o_orderstatus") == "O", conflict).when(F.col("o_orderstatus") == "P", header).alias("reasons"),
        F.when(F.col("o_orderstatus") == "F", F.create_map(alias, F.lit("gross"))).alias("columns"))


def _configured(spark, sf_dir):
    """Customers without debt have an orders feed; those in debt only a refunds feed."""
    source = F.when(F.col("c_acctbal") >= 0, F.lit("orders")).otherwise(F.lit("refunds"))
    return d.table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("tenant_id"), source.alias("source"))


@query
def batch_health(spark, sf_dir):
    df = health.batch_health(_year_manifest(spark, sf_dir), _year_ledger(spark, sf_dir))
    return df.withColumn("reason_codes", F.array_join("reason_codes", ","))


@query
def conflicting_redelivery(spark, sf_dir):
    df = health.conflicting_redelivery(_year_manifest(spark, sf_dir), _year_ledger(spark, sf_dir))
    return df.withColumn("reason_codes", F.array_join("reason_codes", ","))


@query
def stale_sources(spark, sf_dir):
    fresh = health.freshness(_year_manifest(spark, sf_dir), _year_ledger(spark, sf_dir), _configured(spark, sf_dir))
    return health.stale_sources(fresh)


@query
def no_manifest_entries(spark, sf_dir):
    return health.no_manifest_entries(_year_manifest(spark, sf_dir), _configured(spark, sf_dir))


@query
def source_not_configured(spark, sf_dir):
    return health.source_not_configured(_year_manifest(spark, sf_dir), _configured(spark, sf_dir))


@query
def alias_notes(spark, sf_dir):
    return health.alias_notes(_year_ledger(spark, sf_dir)).select("tenant_id", "source", "header", "column_name", "batches")


# --- files: documents as delivered files ---------------------------------------------------------------


def _documents(spark, sf_dir):
    return d.table(spark, sf_dir, "documents").select(
        F.lit("docs").alias("tenant_id"), F.col("lang").alias("source"), F.col("doc_id").alias("batch_no"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "text")


@query
def content_hash(spark, sf_dir):
    return _documents(spark, sf_dir).select("source", "batch_no", "sha256")


@query
def duplicate_content(spark, sf_dir):
    files = _documents(spark, sf_dir).drop("text")
    return replay.first_of_content(files).filter("first_batch < batch_no").select("source", "batch_no", "first_batch")


@query
def replay_classification(spark, sf_dir):
    """Labelled documents were loaded before (toxic ones with other text); two languages are configured."""
    docs = _documents(spark, sf_dir)
    labels = d.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("batch_no"), "toxic")
    before = F.when(F.col("toxic") == 1, F.concat("text", F.lit(" (before)"))).otherwise(F.col("text"))
    loaded = docs.join(labels, "batch_no").withColumn("sha256", F.sha2(before.cast("binary"), 256)).groupBy(
        "tenant_id", "source", "sha256").agg(F.min("batch_no").alias("batch_no"))
    ledger = loaded.withColumn("status", F.lit("loaded")).withColumn("row_count", F.col("batch_no") + 1)
    configured = docs.select("tenant_id", "source").distinct().filter(F.col("source").isin("en", "fr"))
    done = cut(replay.classify_replays(docs.drop("text"), ledger, configured), "replays")
    first = replay.first_of_content(done.filter("verdict = 'parse'")).select("source", "batch_no", "first_batch")
    again = F.when(F.col("first_batch") < F.col("batch_no"), replay.duplicate_reason(F.col("first_batch")))
    why = F.coalesce(F.try_element_at("reasons", F.lit(1)), again)
    status = F.when(F.col("verdict") == "skipped", F.lit("skipped")).when(why.isNotNull(), F.lit("quarantined")).otherwise(F.lit("loaded"))
    return done.join(first, ["source", "batch_no"], "left").select(
        "source", "batch_no", status.alias("status"), why["code"].alias("code"), why["message"].alias("message"), "earlier_rows")


def _document_lines(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), "text")
    return cut(csv_files.check_lines(lines.number_lines(lines.lines_of(docs, "file", "text")).lines), "checked")


@query
def csv_line_numbers(spark, sf_dir):
    """Every document read as CSV: its records by start line, their last line and number of fields."""
    return csv_files.record_shapes(_document_lines(spark, sf_dir))


@query
def quarantine_reasons(spark, sf_dir):
    """Why each document is no CSV file."""
    found = csv_files.shape_reasons(csv_files.record_shapes(_document_lines(spark, sf_dir)))
    return found.select("file", "reason.code", "reason.line")


def _round_trip(spark, df: DataFrame, source: str) -> DataFrame:
    """Write a delivery's canonical columns as files of the source's format and parse them back."""
    folder = f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}"
    if SOURCE_FORMAT[source] == "csv":
        df.write.option("header", True).option("escape", '"').csv(folder)
    else:
        df.write.json(folder)
    names_ = lines.list_files(spark, folder).filter("bytes > 0 AND file NOT LIKE '%/\\_%'")
    files = cut(names_.select("file", F.lit("t0").alias("tenant_id"), F.lit(source).alias("source")), "files")
    configured = files.select("tenant_id", "source").distinct()
    none = spark.createDataFrame([], "tenant_id string, source string, alias string, canonical string")
    rules = header_rules(spark, none, configured)
    parsed = (parse_csv if SOURCE_FORMAT[source] == "csv" else parse_ndjson)(files, lines.scan_lines(spark, [folder]), rules)
    return parsed.records.select(*[F.col("payload")[c].alias(c) for c in SOURCE_COLUMNS[source]])


@query
def csv_records(spark, sf_dir):
    """Orders written as CSV files with quotes, commas and line breaks in fields, and read back."""
    text = d.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").cast("date").cast("string").alias("created_at"),
        F.concat(F.lit('"'), "o_orderpriority", F.lit('", said')).alias("channel"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("gross"), F.lit("USD").alias("currency"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("c\n"), "o_custkey")).otherwise(
            F.col("o_custkey").cast("string")).alias("customer_email"))
    return _round_trip(spark, text, "orders")


@query
def ndjson_records(spark, sf_dir):
    """Events written as JSON lines (numbers kept as numbers) and read back as text."""
    text = d.table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("type"), F.col("props").alias("email"),
        F.get_json_object("props", "$.k").alias("campaign_id"), F.col("ts").cast("date").cast("string").alias("occurred_at"))
    return _round_trip(spark, text, "email_events")


# --- loads: orders as the files of two deliveries ------------------------------------------------------

# Batches are years. In the first delivery batch 5 has a strange header, batch 8 repeats the first year and batch 9 is not
# there yet; in the second batch 2 has other amounts, batch 5 is right and batch 9 has arrived.
FIRST_YEAR, STRANGE, CHANGED, REPEATED, LATE_BATCH = 1994, 5, 2, 8, 9


def _delivery_files(spark, sf_dir, folder: str, second: bool) -> DataFrame:
    """Write one delivery and give back its manifest."""
    o = d.table(spark, sf_dir, "orders").select(
        d._tenant("o_orderkey"), (F.year("o_orderdate") - FIRST_YEAR).alias("batch_no"), "o_orderkey", "o_custkey", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    again = o.filter("batch_no = 1").withColumn("batch_no", F.lit(REPEATED))
    rows = o.unionByName(again)
    if second:
        rows = rows.unionByName(o.filter("batch_no = 1 AND o_orderkey % 5 = 0").withColumn("batch_no", F.lit(LATE_BATCH)))
        rows = rows.withColumn("price", F.when(F.col("batch_no") == CHANGED, F.col("price") + 1).otherwise(F.col("price")))
    text = rows.select(
        "tenant_id", F.col("batch_no").cast("int").alias("batch_no"), F.col("o_orderkey").alias("order_id"), F.col("day").alias("created_at"),
        F.col("o_orderpriority").alias("channel"), F.col("price").alias("gross"), F.lit("USD").alias("currency"), F.col("o_custkey").alias("customer_email"))
    parts = [(text.filter(f"batch_no <> {STRANGE}"), "usual"), (text.filter(f"batch_no = {STRANGE}"), "strange")]
    for part, name in parts:
        own = part if second or name == "usual" else part.withColumnRenamed("gross", "brutto")
        # A file must hold a batch in one order, whatever the cluster: its bytes are compared with those of other batches.
        own.repartition("tenant_id", "batch_no").sortWithinPartitions("tenant_id", "batch_no", "order_id").write.partitionBy(
            "tenant_id", "batch_no").option("header", True).csv(f"{folder}/{name}")
    listing = lines.list_files(spark, folder).filter("bytes > 0 AND file LIKE '%.csv'")
    path = F.regexp_extract("file", "/((?:usual|strange)/tenant_id=.*)$", 1)
    entries = listing.select(F.regexp_extract("file", "tenant_id=([^/]*)", 1).alias("tenant_id"), F.regexp_extract("file", "batch_no=([0-9]+)", 1).cast("int").alias("batch_no"), path.alias("path"))
    if not second:
        entries = entries.unionByName(entries.select("tenant_id").distinct().select(
            "tenant_id", F.lit(LATE_BATCH).alias("batch_no"), F.lit("usual/late.csv").alias("path")))
    return cut(entries.select(
        "tenant_id", F.lit("orders").alias("source"), "batch_no", "path", F.lit("1992-01-01").alias("covers_from"), F.lit("1998-12-31").alias("covers_to")), "manifest")


def _two_loads(spark, sf_dir) -> tuple[Store, list[DataFrame]]:
    base = f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}"
    tenants = small_frame(spark, [("t0", "t0", "USD", ""), ("t1", "t1", "USD", "")], "tenant_id string, display_name string, currency string, fixtures_dir string")
    none = "tenant_id string, source string, "
    control_ = Control(
        tenants, small_frame(spark, [("t0", "orders"), ("t1", "orders")], "tenant_id string, source string"),
        small_frame(spark, [], none + "canonical string, cpos int, apos int, alias string"), small_frame(spark, [], none + "column_name string, raw_value string, canonical_value string"))
    store, results = Store(spark, f"{base}/store"), []
    for number in (1, 2):
        folder = f"{base}/delivery{number}"
        manifest = _delivery_files(spark, sf_dir, folder, number == 2)
        root = lines.plain_path(folder)
        results.append(cut(load(spark, store, control_, manifest, root, root), "results").withColumn("load", F.lit(number)))
    return store, results


@query
def load_result(spark, sf_dir):
    """What two loads say of every file: loaded, quarantined and why, skipped, missing."""
    _, (first, second) = _two_loads(spark, sf_dir)
    codes = F.array_join(F.transform("reasons", lambda r: r["code"]), ",")
    return first.unionByName(second).select("load", "tenant_id", "batch_no", "status", "row_count", codes.alias("codes"))


@query
def load_raw(spark, sf_dir):
    """Every line that both loads left, with its line number and amount as delivered."""
    store, _ = _two_loads(spark, sf_dir)
    rows = staging.loaded_record(store.read("raw"), store.read("ledger"))
    return rows.select("tenant_id", "batch_no", "line_no", F.col("payload")["order_id"].alias("order_id"), F.col("payload")["gross"].alias("gross"))


# --- headers: every customer delivers ad spend under headers of its segment ----------------------------


def _resolved_headers(spark, sf_dir):
    segment = F.col("c_mktsegment")
    headers = (
        F.when(segment == "AUTOMOBILE", F.array(*map(F.lit, ["date", "campaign_id", "platform", "spend"])))
        .when(segment == "BUILDING", F.array(*map(F.lit, ["date", "campaign_id", "platform", "cost_usd"])))
        .when(segment == "FURNITURE", F.array(F.lit("date"), F.col("c_name"), F.lit("platform"), F.lit("spend")))
        .when(segment == "HOUSEHOLD", F.array(*map(F.lit, ["date", "date", "campaign_id", "spend"])))
        .otherwise(F.array(*map(F.lit, ["spend", "cost_usd", "campaign_id", "Platform"]))))
    files = d.table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("t0").alias("tenant_id"), F.lit("ad_spend").alias("source"), headers.alias("headers"))
    alias = small_frame(spark, [("t0", "ad_spend", "cost_usd", "spend")], "tenant_id string, source string, alias string, canonical string")
    configured = small_frame(spark, [("t0", "ad_spend")], "tenant_id string, source string")
    return resolve_headers(files, header_rules(spark, alias, configured))


@query
def header_resolution(spark, sf_dir):
    reasons = F.array_join(F.transform("reasons", lambda r: F.concat(r["code"], F.lit(": "), r["message"])), "; ")
    return _resolved_headers(spark, sf_dir).select("c_custkey", reasons.alias("reasons"))


@query
def adapted_headers(spark, sf_dir):
    """Headers read through a declared alias, in the files that would load."""
    fine = _resolved_headers(spark, sf_dir).filter(F.size("reasons") == 0)
    return fine.select("c_custkey", F.explode(adapted(F.col("columns"))).alias("header", "column_name"))


# --- functions -----------------------------------------------------------------------------------------


@query
def value_mapping(spark, sf_dir):
    o = d.table(spark, sf_dir, "orders").select("o_orderkey", d._tenant("o_orderkey"), F.col("o_orderpriority").alias("channel"))
    return map_values(o, d.value_map(spark), "orders", "channel", "channel")


@query
def column_value(spark, sf_dir):
    """Two keys carry the type: `event` comes first in key order and is blank for some event types."""
    first = F.when(F.col("event_type").isin("view", "error"), F.lit("   ")).when(
        F.col("event_type") == "click", F.lit(None)).otherwise(F.get_json_object("props", "$.k"))
    second = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat(F.lit("  "), F.col("event_type")))
    e = d.table(spark, sf_dir, "events").select("event_id", F.create_map(F.lit("type"), second, F.lit("event"), first).alias("payload"))
    keys = readers(F.create_map(F.lit("type"), F.lit("type"), F.lit("event"), F.lit("type")))
    return e.select("event_id", read_value(F.col("payload"), keys["type"]).alias("value"))


@query
def safe_casts(spark, sf_dir):
    p, day = F.col("o_orderpriority"), F.col("o_orderdate").cast("date").cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    amount = F.when(p == "1-URGENT", F.concat(price, F.lit("O"))).when(p == "2-HIGH", F.concat(F.lit("+"), price)).when(
        p == "3-MEDIUM", F.lit("NaN")).when(p == "5-LOW", F.concat(price, F.lit("00001"))).otherwise(price)
    when = F.when(p == "1-URGENT", F.concat(day, F.lit("T23:30:00-02:00"))).when(p == "2-HIGH", F.concat(day, F.lit("X"))).when(
        p == "3-MEDIUM", F.concat(day, F.lit(" 01:02:03"))).when(p == "5-LOW", F.lit("today")).otherwise(day)
    o = d.table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", casts.try_numeric(amount).cast("double").alias("amount"),
        F.unix_micros(casts.try_timestamp_utc(when)).alias("at_us"), casts.utc_day(casts.try_timestamp_utc(when)).alias("utc_day"),
        casts.try_iso_date(when).alias("iso_day"))


# --- control tables and scope --------------------------------------------------------------------------


@query
def tenant_upsert(spark, sf_dir):
    """Customers as tenants: rich ones are new, indebted ones changed their name."""
    c = d.table(spark, sf_dir, "customer").withColumn("tenant_id", F.concat(F.lit("c"), F.col("c_custkey")))
    stored = c.filter("c_acctbal <= 9000").select("tenant_id", F.col("c_name").alias("display_name"), F.lit("USD").alias("currency"))
    name = F.when(F.col("c_acctbal") < 0, F.upper("c_name")).otherwise(F.col("c_name"))
    return control.tenant_changes(stored, c.select("tenant_id", name.alias("display_name"), F.lit("USD").alias("currency")))


@query
def value_map_sync(spark, sf_dir):
    c = d.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("tenant_id"), F.lit("orders").alias("source"),
        F.lit("channel").alias("column_name"), F.col("c_name").alias("raw_value"), F.col("c_mktsegment").alias("canonical_value"),
        "c_acctbal")
    moved = F.when(F.col("c_acctbal") < 0, F.lower("canonical_value")).otherwise(F.col("canonical_value"))
    desired = c.filter("c_acctbal <= 9000").withColumn("canonical_value", moved)
    return control.value_map_changes(c, desired)


@query
def tenant_scope(spark, sf_dir):
    staged = scope.scope(_staged(spark, sf_dir, "orders"), "t1")
    return staged.groupBy("tenant_id", "batch_no").agg(F.count(F.lit(1)).alias("orders"))
