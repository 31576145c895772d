"""Deliveries of two clients derived from the whole star-schema tables.

orders (and a redelivery of pending ones), lineitem (ad spend; returned lines as refunds) and events
(email events) become raw payloads with original headers, exactly what the loader would have stored.
Batches follow the calendar, so expected windows are years (six-day windows for email).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.contract import SOURCE_COLUMNS, SOURCES
from tidemark.session import configure, small_frame

TENANTS = [("t0", "Client zero", "USD"), ("t1", "Client one", "EUR")]
BATCHES = {"orders": 8, "email_events": 5, "ad_spend": 7, "refunds": 7}
REDELIVERY = 8
VALUE_MAP = [
    ("t0", "orders", "channel", "1-URGENT", "facebook"),
    ("t0", "orders", "channel", "2-HIGH", "google"),
    ("t0", "orders", "channel", "3-MEDIUM", "email"),
    ("t1", "orders", "channel", "1-URGENT", "facebook"),
    ("t1", "orders", "channel", "2-HIGH", "google"),
    ("t1", "orders", "channel", "5-LOW", "direct"),
    ("t0", "ad_spend", "platform", "A", "facebook"),
    ("t0", "ad_spend", "platform", "N", "google"),
    ("t0", "ad_spend", "platform", "R", "email"),
    ("t1", "ad_spend", "platform", "A", "facebook"),
    ("t1", "ad_spend", "platform", "N", "google"),
    ("t1", "ad_spend", "platform", "R", "google"),
    ("t0", "email_events", "type", "view", "open"),
    ("t0", "email_events", "type", "signup", "delivered"),
    ("t0", "email_events", "type", "purchase", "unsubscribe"),
    ("t1", "email_events", "type", "view", "open"),
    ("t1", "email_events", "type", "signup", "delivered"),
]
# Batches delivered under a declared alias: (source, batches) -> (alias, canonical column).
ALIASED = {"ad_spend": ([5, 6, 7], "cost_usd", "spend"), "email_events": ([2, 4], "event", "type")}
# No file maps more than one raw key to a column.
WIDTH = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tenants(spark: SparkSession) -> DataFrame:
    return small_frame(spark, TENANTS, "tenant_id string, display_name string, currency string")


def value_map(spark: SparkSession) -> DataFrame:
    return small_frame(
        spark, VALUE_MAP, "tenant_id string, source string, column_name string, raw_value string, canonical_value string")


def file_id(tenant: str, source: str, batch: int) -> int:
    return 1000 * (1 + int(tenant[1:])) + 100 * SOURCES.index(source) + batch


def _file_id(source: str) -> Column:
    tenant = F.substring("tenant_id", 2, 1).cast("bigint")
    return F.lit(1000) * (tenant + 1) + F.lit(100 * SOURCES.index(source)) + F.col("batch_no")


def header_map(source: str, batch: int) -> dict[str, str]:
    columns = {c: c for c in SOURCE_COLUMNS[source]}
    batches, alias, column = ALIASED.get(source, ([], "", ""))
    if batch in batches:
        del columns[column]
        columns[alias] = column
    return columns


def path(tenant: str, source: str, batch: int) -> str:
    return f"{tenant}/{source}/batch_{batch:02d}"


def window(source: str, batch: int) -> tuple[str, str]:
    if source == "email_events":
        return f"2024-01-{6 * batch - 5:02d}", f"2024-01-{6 * batch:02d}"
    if batch == REDELIVERY:
        return "2002-01-01", "2002-01-01"
    return f"{1994 + batch}-01-01", f"{1994 + batch}-12-31"


def manifest(spark: SparkSession) -> DataFrame:
    rows = [
        (t, s, b, path(t, s, b), *window(s, b)) for t, _, _ in TENANTS for s in SOURCES for b in range(1, BATCHES[s] + 1)
    ]
    return small_frame(
        spark, rows, "tenant_id string, source string, batch_no int, path string, covers_from string, covers_to string")


def ledger(spark: SparkSession, never_loaded: dict[tuple[str, str, int], str] | None = None) -> DataFrame:
    """Every batch loaded once, but for `never_loaded`: (tenant, source, batch) -> not_received | quarantined."""
    rows = []
    for t, _, _ in TENANTS:
        for s in SOURCES:
            for b in range(1, BATCHES[s] + 1):
                status = (never_loaded or {}).get((t, s, b), "loaded")
                if status == "not_received":
                    continue
                reasons = [{"code": "unknown_header", "message": 'header "x"', "line": None}] if status == "quarantined" else None
                columns = header_map(s, b) if status == "loaded" else None
                rows.append((t, file_id(t, s, b), s, b, path(t, s, b), status, columns, reasons))
    return small_frame(
        spark, rows,
        "tenant_id string, batch_file_id bigint, source string, batch_no int, path string, status string, "
        "columns map<string,string>, reasons array<struct<code:string,message:string,line:int>>")


def _payload(df: DataFrame, source: str, values: dict[str, Column], line_no: Column) -> DataFrame:
    """Raw rows under the headers each batch was delivered with."""
    keys = {c: F.lit(c) for c in SOURCE_COLUMNS[source]}
    if source in ALIASED:
        batches, alias, column = ALIASED[source]
        keys[column] = F.when(F.col("batch_no").isin(batches), F.lit(alias)).otherwise(F.lit(column))
    pairs = [x for c in SOURCE_COLUMNS[source] for x in (keys[c], values[c].cast("string"))]
    return df.select(
        "tenant_id", F.lit(source).alias("source"), _file_id(source).alias("batch_file_id"),
        line_no.cast("bigint").alias("line_no"), F.create_map(*pairs).alias("payload"))


def _tenant(key: str) -> Column:
    return F.concat(F.lit("t"), (F.col(key) % 2).cast("string")).alias("tenant_id")


def _year_batch(day: str) -> Column:
    return (F.year(day) - 1994).alias("batch_no")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("tenant_id", _tenant("o_orderkey"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    pending = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    odd_date = (F.col("o_orderstatus") != "P") & (F.col("o_orderpriority") == "5-LOW") & (price > 400000)
    day = F.col("o_orderdate").cast("date")
    common = {
        "order_id": F.concat(F.lit("o-"), F.col("o_orderkey")),
        "channel": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("  ")).otherwise(F.col("o_orderpriority")),
        "currency": F.lit("USD"),
        "customer_email": F.concat(F.lit("c"), F.col("o_custkey"), F.lit("@example.invalid")),
    }
    first = _payload(o.withColumn("batch_no", _year_batch("o_orderdate")), "orders", {
        **common,
        "created_at": F.when(odd_date, F.date_format(day, "yyyy/MM/dd")).otherwise(
            F.concat(day.cast("string"), F.lit("T00:00:00Z"))),
        "gross": F.when(pending, F.lit("pending")).otherwise(price.cast("string")),
    }, F.col("o_orderkey") + 2)
    # Pending orders are delivered again: settled a little lower, and high-priority ones a day later.
    later = F.when(F.col("o_orderpriority") == "2-HIGH", F.date_add(day, 1)).otherwise(day)
    again = _payload(
        o.filter("o_orderstatus = 'P'").withColumn("batch_no", F.lit(REDELIVERY)), "orders", {
            **common,
            "created_at": F.concat(later.cast("string"), F.lit("T00:00:00Z")),
            "gross": (price - F.lit(100).cast("decimal(18,2)")).cast("string"),
        }, F.col("o_orderkey") + 2)
    return first.unionByName(again)


def raw_ad_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").withColumn("tenant_id", _tenant("l_orderkey")).withColumn(
        "batch_no", _year_batch("l_shipdate"))
    spend = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    unread = (F.col("l_tax").cast("decimal(4,2)") == 0) & (F.col("l_quantity") == 1)
    return _payload(line, "ad_spend", {
        "date": F.col("l_shipdate").cast("date"), "campaign_id": F.concat(F.lit("c-"), F.col("l_suppkey")),
        "platform": F.col("l_returnflag"), "spend": F.when(unread, F.lit("n/a")).otherwise(spend.cast("string")),
    }, F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def raw_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines. The ones sold at full price name no order, the deepest discounted an unknown one."""
    line = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumn(
        "tenant_id", _tenant("l_orderkey")).withColumn("batch_no", _year_batch("l_shipdate"))
    discount = F.col("l_discount").cast("decimal(4,2)")
    amount = F.col("l_extendedprice").cast("decimal(18,2)") * discount
    order = F.when(discount == 0, F.lit(None)).when(
        discount >= F.lit("0.10").cast("decimal(4,2)"), F.concat(F.lit("x-"), F.col("l_orderkey"))
    ).otherwise(F.concat(F.lit("o-"), F.col("l_orderkey")))
    return _payload(line, "refunds", {
        "refund_id": F.concat_ws("-", F.lit("r"), "l_orderkey", "l_linenumber"),
        "refunded_at": F.col("l_shipdate").cast("date"), "order_id": order, "amount": amount, "currency": F.lit("USD"),
    }, (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000000 + F.col("l_partkey"))


def raw_email_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("tenant_id", _tenant("user_id")).withColumn(
        "batch_no", F.floor((F.dayofmonth("ts") - 1) / 6).cast("int") + 1)
    return _payload(e, "email_events", {
        "event_id": F.concat(F.lit("e-"), F.col("event_id")), "type": F.col("event_type"),
        "email": F.concat(F.lit("u"), F.col("user_id"), F.lit("@example.invalid")),
        "campaign_id": F.concat(F.lit("k-"), F.get_json_object("props", "$.k")), "occurred_at": F.col("ts"),
    }, F.col("event_id") + 1)


RAW = {"orders": raw_orders, "email_events": raw_email_events, "ad_spend": raw_ad_spend, "refunds": raw_refunds}


def raw(spark: SparkSession, sf_dir: str, sources: list[str] | None = None) -> DataFrame:
    return reduce(DataFrame.unionByName, [RAW[s](spark, sf_dir) for s in sources or SOURCES])
