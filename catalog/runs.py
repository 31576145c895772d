"""Queries that run the engine's plans over files: a delivery derived from orders and events, written, loaded, published.

t0 and t1 have two feeds. Orders are CSV files of one year each (t1 under the alias `total`); email events are JSON lines of six
days each, every second line under the alias `event`, and t1's fourth file holds lines that are no objects. What comes late:
the fifth year's orders, corrections of the first year (batch 9), and email batches 4 and 5.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from catalog import deliveries as d
from catalog.queries import query
from tidemark.functions.values import adapted
from tidemark.operators import scope
from tidemark.plans.load import load
from tidemark.plans.report import history, publish
from tidemark.plans.seed import sync_control
from tidemark.plans.store import Store
from tidemark.session import cut, shared_folder
from tidemark.sources import lines
from tidemark.sources.manifest import read_manifest
from tidemark.sources.tenants import Control, read_tenants
from tidemark.streaming.landing import load_stream as start_stream

FIRST_YEAR, LATE_YEAR, CORRECTIONS, EMAIL_DAYS, LATE_EMAILS, BROKEN = 1994, 5, 9, 6, (4, 5), 4
CHANNELS = {"1-URGENT": "facebook", "2-HIGH": "google", "5-LOW": "direct"}
TYPES = {"view": "open", "signup": "delivered", "purchase": "unsubscribe"}


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file in the shared folder under a name of its own, which Spark's writers cannot give."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def _tenant_file(tenant: str, currency: str) -> str:
    orders = {"columnAliases": {"gross": ["total"]} if tenant == "t1" else {}, "valueMaps": {"channel": CHANNELS}}
    emails = {"columnAliases": {"type": ["event"]}, "valueMaps": {"type": TYPES}}
    return json.dumps({
        "id": tenant, "displayName": f"Client {tenant}", "currency": currency, "fixturesDir": f"fixtures/tenant_id={tenant}",
        "sources": {"orders": orders, "email_events": emails}})


class Delivered:
    """A delivery folder and how its files arrive."""

    def __init__(self, spark: SparkSession, sf_dir: str, emails: bool = True):
        self.spark, self.sf_dir, self.emails = spark, sf_dir, emails
        self.base = f"{lines.plain_path(shared_folder(spark))}/tidemark/{uuid.uuid4().hex}"
        self.root = f"{self.base}/delivery"
        self.store = Store(spark, f"{self.base}/store")
        for tenant, currency in (("t0", "USD"), ("t1", "EUR")):
            _put(spark, f"{self.root}/tenants/{tenant}.json", _tenant_file(tenant, currency))

    def _orders(self, late: bool) -> None:
        key = F.col("o_orderkey")
        o = d.table(self.spark, self.sf_dir, "orders").select(
            d._tenant("o_orderkey"), (F.year("o_orderdate") - FIRST_YEAR).cast("int").alias("batch_no"), key.alias("order_id"),
            F.col("o_orderdate").cast("date").alias("created_at"), F.col("o_orderpriority").alias("channel"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("gross"), F.lit("USD").alias("currency"), F.col("o_custkey").alias("customer_email"))
        if late:
            moved = F.when(F.col("order_id") % 10 == 0, F.date_add("created_at", 1)).otherwise(F.col("created_at"))
            again = o.filter("batch_no = 1 AND order_id % 5 = 0").withColumns(
                {"batch_no": F.lit(CORRECTIONS), "gross": (F.col("gross") + 1).cast("decimal(18,2)"), "created_at": moved})
            o = o.filter(F.col("batch_no") == LATE_YEAR).unionByName(again)
        else:
            o = o.filter(F.col("batch_no") != LATE_YEAR)
        o = o.withColumn("source", F.lit("orders"))
        for tenant, name in (("t0", "gross"), ("t1", "total")):
            own = o.filter(F.col("tenant_id") == tenant).withColumnRenamed("gross", name)
            own.repartition("batch_no").write.mode("append").partitionBy("tenant_id", "source", "batch_no").option("header", True).csv(f"{self.root}/fixtures")

    def _emails(self, late: bool) -> None:
        e = d.table(self.spark, self.sf_dir, "events").withColumn("tenant_id", d._tenant("user_id")).withColumn(
            "batch_no", F.floor((F.dayofmonth("ts") - 1) / EMAIL_DAYS).cast("int") + 1)
        e = e.filter(F.col("batch_no").isin(*LATE_EMAILS) == late)

        def line(kind: str) -> Column:
            return F.to_json(F.struct(
                F.col("event_id"), F.col("event_type").alias(kind), F.col("user_id").cast("string").alias("email"), F.lit("k").alias("campaign_id"),
                F.date_format("ts", "yyyy-MM-dd").alias("occurred_at")))

        broken = (F.col("tenant_id") == "t1") & (F.col("batch_no") == BROKEN) & (F.col("event_id") % 100 == 0)
        text = F.when(broken, F.lit("[1, 2]")).when(F.col("event_id") % 2 == 0, line("event")).otherwise(line("type"))
        e.select("tenant_id", F.lit("email_events").alias("source"), "batch_no", text.alias("value")).repartition("tenant_id", "batch_no").write.mode(
            "append").partitionBy("tenant_id", "source", "batch_no").text(f"{self.root}/fixtures")

    def _manifest(self) -> None:
        """Every batch that is expected; those that have not arrived name a file that is not there."""
        files = lines.list_files(self.spark, f"{self.root}/fixtures").filter("bytes > 0 AND file LIKE '%/batch_no=%'")
        at = {(t, s, int(b)): path for path, t, s, b in files.select(
            F.regexp_extract("file", "/fixtures/(tenant_id=.*)$", 1), F.regexp_extract("file", "tenant_id=([^/]*)", 1),
            F.regexp_extract("file", "source=([^/]*)", 1), F.regexp_extract("file", "batch_no=([0-9]+)", 1)).collect()}  # one row a batch file
        entries = []
        for tenant in ("t0", "t1"):
            for source, batches in (("orders", [1, 2, 3, 4, 5, 6, 7, CORRECTIONS]), ("email_events", [1, 2, 3, 4, 5] if self.emails else [])):
                for b in batches:
                    if source == "email_events":
                        window = (f"2024-01-{EMAIL_DAYS * b - 5:02d}", f"2024-01-{EMAIL_DAYS * b:02d}")
                    else:
                        window = ("1995-01-01", "1995-01-31") if b == CORRECTIONS else (f"{FIRST_YEAR + b}-01-01", f"{FIRST_YEAR + b}-12-31")
                    path = at.get((tenant, source, b), f"tenant_id={tenant}/{source}-{b}-not-there")
                    entries.append({"tenant": tenant, "source": source, "batch": b, "path": path, "covers_from": window[0], "covers_to": window[1]})
        _put(self.spark, f"{self.root}/fixtures/manifest.json", json.dumps({"batches": entries}))

    def arrive(self, late: bool) -> Delivered:
        self._orders(late)
        if self.emails:
            self._emails(late)
        self._manifest()
        return self

    def control(self) -> Control:
        return read_tenants(self.spark, f"{self.root}/tenants")

    def manifest(self) -> DataFrame:
        return read_manifest(self.spark, f"{self.root}/fixtures/manifest.json")

    def load(self) -> DataFrame:
        control = self.control()
        sync_control(control, self.store)
        return cut(load(self.spark, self.store, control, self.manifest(), self.root), "results")


def _ledger(here: Delivered) -> DataFrame:
    """Every attempt: from how many lines and sets of keys a file loaded, under which aliases, and what was refused why."""
    lines_of = here.store.read("raw").groupBy("tenant_id", "batch_file_id").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct(F.map_keys("payload")).alias("key_sets"))
    headers = F.array_sort(F.map_keys(adapted(F.col("columns"))))
    return here.store.read("ledger").join(lines_of, ["tenant_id", "batch_file_id"], "left").select(
        "tenant_id", "source", "batch_no", "status", "row_count", "lines", "key_sets", F.array_join(F.coalesce(headers, F.array().cast("array<string>")), ",").alias("aliases"),
        F.array_join(F.transform("reasons", lambda r: r["code"]), ",").alias("codes"))


@query
def load_stream(spark, sf_dir):
    """The ledger after a stream has met both arrivals of orders, was restarted in between, and lost its checkpoint once."""
    here = Delivered(spark, sf_dir, emails=False)

    def drain(checkpoint: str) -> None:
        start_stream(spark, here.store, here.root, f"{here.base}/{checkpoint}").awaitTermination()

    here.arrive(False)
    drain("first")
    here.arrive(True)
    drain("first")
    drain("second")
    return _ledger(here)


@query
def load_ledger(spark, sf_dir):
    """The ledger after both arrivals of both feeds were loaded at once."""
    here = Delivered(spark, sf_dir)
    here.arrive(False).arrive(True).load()
    return _ledger(here)


@query
def load_summary(spark, sf_dir):
    """Files by status over two loads of both arrivals: the second one skips what it has."""
    here = Delivered(spark, sf_dir)
    first = here.arrive(False).load().withColumn("load", F.lit(1))
    second = here.arrive(True).load().withColumn("load", F.lit(2))
    return first.unionByName(second).groupBy("load", "tenant_id", "source", "status").agg(F.count(F.lit(1)).alias("files"))


def _reports(spark, sf_dir) -> tuple[Delivered, DataFrame]:
    """Publish after each arrival, and once more. Before the second run one dies: its versions are there, its run row is not."""
    here, said = Delivered(spark, sf_dir, emails=False), None
    for number in (1, 2, 3):
        if number < 3:
            here.arrive(number == 2).load()
        if number == 2:
            lost = here.store.read("published").withColumns({"run_id": F.col("run_id") + 1, "version": F.col("version") + 1, "metrics": F.lit("{}")})
            here.store.append("published", cut(lost, "lost"))
        done = cut(publish(spark, here.store, here.manifest(), ["daily_revenue"]), "done").withColumn("run", F.lit(number))
        said = done if said is None else said.unionByName(done)
    return here, said


@query
def publish_run(spark, sf_dir):
    """What three runs of the report did for each client; the last one finds nothing new and leaves no run."""
    here, said = _reports(spark, sf_dir)
    runs = here.store.read("run").groupBy("tenant_id").agg(F.count(F.lit(1)).alias("runs"))
    return said.join(runs, "tenant_id").select(
        "run", "tenant_id", F.col("run_id").isNotNull().alias("recorded"), "published", "restated", "unchanged", "withheld", "runs")


@query
def publish_history(spark, sf_dir):
    """Every version of every day's revenue, in which run, what it was before and which batches changed it."""
    here, _ = _reports(spark, sf_dir)
    number = F.dense_rank().over(Window.partitionBy("tenant_id").orderBy("run_id"))
    runs = here.store.read("run").select("tenant_id", "run_id").distinct().withColumn("run", number)

    def amount(text: str, name: str) -> Column:
        return F.get_json_object(text, f"$.{name}")

    told = history(here.store).join(runs, ["tenant_id", "run_id"])
    return told.select(
        "tenant_id", "day", "version", "run", amount("metrics", "orders").cast("int").alias("orders"), amount("metrics", "gross").cast("double").alias("gross"),
        amount("before", "gross").cast("double").alias("gross_before"), F.regexp_extract("path", "batch_no=([0-9]+)", 1).cast("int").alias("batch_no"))


@query
def publish_withheld(spark, sf_dir):
    """Days that the first run holds back, by the window that is open and why; windows that hold nothing back have no day."""
    here, _ = _reports(spark, sf_dir)
    first = here.store.committed("withheld")
    lowest = here.store.read("run").groupBy("tenant_id").agg(F.min("run_id").alias("run_id"))
    return first.join(lowest, ["tenant_id", "run_id"]).select("tenant_id", "mart", "source", "batch_no", "status", "day")


@query
def scoped_read(spark, sf_dir):
    """Orders by batch as a session sees them through views: those of the client it names, none while it names none."""
    rows = d.raw_orders(spark, sf_dir).select("tenant_id", "batch_file_id", "line_no")
    scope.scoped_views(spark, {"scoped_orders": rows})
    nobody = spark.sql("SELECT 'nobody' AS reader, tenant_id, batch_file_id FROM scoped_orders")
    spark.sql("SET VARIABLE current_tenant = 't1'")
    one = spark.sql("SELECT 't1' AS reader, tenant_id, batch_file_id FROM scoped_orders")
    return nobody.unionByName(one).groupBy("reader", "tenant_id", "batch_file_id").agg(F.count(F.lit(1)).alias("lines"))


@query
def scoped_write(spark, sf_dir):
    """Lines appended to the raw layer in t0's scope: its own are written; a job that meets another client's writes nothing."""
    store = Store(spark, f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}/store")
    rows = d.raw_orders(spark, sf_dir).withColumn("line_no", F.col("line_no").cast("int"))
    store.append("raw", scope.checked_for(scope.scope(rows, "t0"), "t0"))
    try:
        store.append("raw", scope.checked_for(rows, "t0"))
        refused = False
    except Exception as error:
        refused = "row of another tenant" in str(error)
        if not refused:
            raise
    return store.read("raw").groupBy("tenant_id", "batch_file_id").agg(F.count(F.lit(1)).alias("lines")).withColumn("refused", F.lit(refused))
