"""Staging, marts, publishing and health over small deliveries with known results."""

import datetime
import json
from decimal import Decimal

import pytest
from helpers import ORDERS, REFUNDS, SPEND, Delivery, config, entry, event

from tidemark.operators import marts as mart_ops, publishing, quality, scope
from tidemark.plans.check import check
from tidemark.plans.load import load
from tidemark.plans.report import history, publish, reported_metric, stage
from tidemark.plans.seed import sync_control
from tidemark.plans.store import Store
from tidemark.sources.manifest import read_manifest
from tidemark.sources.tenants import read_tenants

D = datetime.date


class Client:
    def __init__(self, spark, tmp_path, body):
        self.spark, self.delivery = spark, Delivery(tmp_path / "d").tenant(body)
        self.store = Store(spark, str(tmp_path / "store"))

    def deliver(self, e, content):
        self.delivery.listed(e).file(e["path"], content)
        return self

    def load(self):
        self.control = read_tenants(self.spark, self.delivery.tenants)
        self.manifest = read_manifest(self.spark, self.delivery.manifest)
        self.changed = [r.tenant_id for r in sync_control(self.control, self.store).collect()]
        self.results = load(self.spark, self.store, self.control, self.manifest, self.delivery.root).collect()
        return self

    def publish(self, **options):
        r = publish(self.spark, self.store, self.manifest, **options).first()
        return (r.run_id is not None, r.published, r.restated, r.unchanged, r.withheld)

    def lines(self, as_of=None):
        return [r.line for r in check(self.spark, self.store, self.control, self.manifest, as_of).lines.collect()]


def orchard(spark, tmp_path):
    """A fruit seller whose words for everything are its own."""
    c = Client(spark, tmp_path, config("orchard", "CZK", {
        "orders": {"columnAliases": {"gross": ["price"], "order_id": ["crate"]}, "valueMaps": {"channel": {"stall": "market", "van": "delivery"}}},
        "email_events": {"columnAliases": {"occurred_at": ["when"]}, "valueMaps": {"type": {"peeked": "open", "left": "unsubscribe"}}},
        "ad_spend": {"columnAliases": {}, "valueMaps": {"platform": {"poster": "market"}}}, "refunds": {"columnAliases": {"amount": ["back"]}}}))
    week = ("2030-10-07", "2030-10-13")
    top = "crate,price,channel,created_at,currency,customer_email"
    c.deliver(entry("orchard", "orders", 1, *week), "\n".join([
        top, "pear-1,12.25,stall,2030-10-07,CZK,v", "plum-1,30,van,2030-10-08T00:30:00+02:00,CZK,v", "quince-1,cheap,stall,2030-10-09,CZK,v",
        "fig-1,0.0000001,stall,2030-10-09,CZK,v", "date-1,1234567890123.00,stall,2030-10-10,CZK,v"]))
    c.deliver(entry("orchard", "orders", 2, *week), f"{top}\npear-1,14.75,stall,2030-10-07,CZK,v\n")
    c.deliver(entry("orchard", "email_events", 1, *week), "\n".join(
        event(event_id=f"w{n}", type=kind, occurred_at="2030-10-08").replace("occurred_at", name) for n, (kind, name) in enumerate(
            [("peeked", "when"), ("left", "occurred_at"), ("delivered", "when")])))
    c.deliver(entry("orchard", "ad_spend", 1, *week), f"{SPEND}\n2030-10-07,wasps,poster,2.95\n2030-10-11,wasps,radio,8\n")
    c.deliver(entry("orchard", "refunds", 1, *week), "refund_id,order_id,refunded_at,back,currency\nb1,plum-1,2030-10-12,4.5,CZK\nb2,lost crate,2030-10-12,1.25,CZK\n")
    return c.load()


def test_a_tenant_by_configuration_only(spark, tmp_path):
    c = orchard(spark, tmp_path)
    assert {r.status for r in c.results} == {"loaded"}
    ledger = c.store.read("ledger")
    staged = stage(c.store, ledger, ["orders", "email_events", "ad_spend", "refunds"])
    got = {r.order_id: (r.channel, r.gross, r.order_date.day, r.batch_no) for r in staged["orders"].collect()}
    assert got["pear-1"] == ("market", Decimal("14.75"), 7, 2) and got["plum-1"] == ("delivery", Decimal(30), 7, 1)
    assert got["quince-1"][1] is None and got["fig-1"][1] == Decimal("0.0000001") and got["date-1"][1] == Decimal("1234567890123")
    built = mart_ops.build(staged, c.store.read("tenant"))
    revenue = {r.day.day: (r.orders, float(r.gross), float(r.refunds), float(r.net), r.orphan_refund_count, float(r.orphan_refund_amount))
               for r in built["daily_revenue"].collect()}
    assert revenue[7] == (2, 44.75, 0.0, 44.75, 0, 0.0) and revenue[12] == (0, 0.0, 4.5, -4.5, 1, 1.25)
    assert revenue[10][1] == 1234567890123.0
    channels = {(r.day.day, r.channel): (float(r.revenue), float(r.spend), None if r.roas is None else str(r.roas)) for r in built["daily_channel_performance"].collect()}
    assert channels[(7, "market")] == (14.75, 2.95, "5.0000") and channels[(7, "delivery")] == (30.0, 0.0, None) and channels[(11, "radio")] == (0.0, 8.0, "0.0000")
    mail = built["daily_email_engagement"].first()
    assert (mail.delivered, mail.opens, mail.clicks, mail.unsubscribes) == (1, 1, 0, 1)
    lines = quality.checked_all(c.store.read("raw"), ledger, c.store.read("value_map"))
    for rows in (quality.invalid_rows(lines), quality.current_invalid_rows(lines)):
        assert [(r.source, r.line_no, r.column_name, r.raw_value, r.problem) for r in rows.collect()] == [("orders", 4, "gross", "cheap", "invalid numeric")]
    assert c.lines()[:2] == ["orchard: 1 finding (5/5 batches loaded, as of 2030-10-13)", "  invalid_rows: orders.gross 1 row (first: batch 1 line 4)"]
    assert '  note: orders batches 1-2 read header "crate" as order_id (declared alias)' in c.lines()

    # A changed map changes what is staged, not what is loaded; saying it twice changes nothing.
    body = json.load(open(f"{c.delivery.tenants}/orchard.json"))
    body["sources"]["orders"]["valueMaps"]["channel"] = {"van": "road"}
    c.delivery.tenant(body)
    assert c.load().changed == ["orchard"] and {r.status for r in c.results} == {"skipped"}
    assert {r.channel for r in stage(c.store, c.store.read("ledger"), ["orders"])["orders"].collect()} == {"stall", "road"}
    assert c.load().changed == []


def only_orders():
    return config("acme", sources={"orders": {"columnAliases": {}}})


def window(batch):
    return entry("acme", "orders", batch, f"2026-03-{2 * batch - 1:02d}", f"2026-03-{2 * batch:02d}")


def order(key, day, gross="10.00"):
    return f"{ORDERS}\n{key},{day}T10:00:00Z,fb,{gross},X,a\n"


def test_versions_restatements_and_tombstones(spark, tmp_path):
    c = Client(spark, tmp_path, only_orders()).deliver(window(1), order("o-1", "2026-03-01")).load()
    one = ["daily_revenue"]
    assert c.publish(marts=one) == (True, 1, 0, 0, 0)
    c.deliver(window(2), order("o-1", "2026-03-02")).load()
    assert c.publish(marts=one) == (True, 2, 1, 0, 0)
    versions = sorted((r.day, r.version, r.metrics is None) for r in c.store.committed("published").collect())
    assert versions == [(D(2026, 3, 1), 1, False), (D(2026, 3, 1), 2, True), (D(2026, 3, 2), 1, False)]
    told = c.store.committed("restatement").first()
    second = c.store.read("ledger").filter("batch_no = 2").first().batch_file_id
    assert (told.day, told.from_version, told.to_version, told.after, told.caused_by) == (D(2026, 3, 1), 1, 2, None, [second])
    assert json.loads(told.before)["gross"] == "10.000000"
    assert [(r.day, r.version) for r in reported_metric(c.store).collect()] == [(D(2026, 3, 2), 1)]
    why = [r.path for r in history(c.store).filter("version = 2").collect()]
    assert why == ["acme/orders/batch_02.csv"]
    assert c.publish(marts=one) == (False, 0, 0, 1, 0)
    # The key comes back: a restatement of the tombstone.
    c.deliver(window(3), order("o-2", "2026-03-01", "3.00")).load()
    assert c.publish(marts=one) == (True, 1, 1, 1, 0)
    back = c.store.committed("restatement").filter("to_version = 3").first()
    assert back.before is None and json.loads(back.after)["gross"] == "3.000000"
    with pytest.raises(ValueError, match="at least one"):
        publish(spark, c.store, c.manifest, [])
    with pytest.raises(ValueError, match="Unknown marts: nope"):
        publish(spark, c.store, c.manifest, ["nope"])


def test_incomplete_windows_are_withheld(spark, tmp_path):
    c = Client(spark, tmp_path, only_orders())
    c.deliver(window(1), order("o-1", "2026-03-01")).deliver(window(3), order("o-3", "2026-03-03") + "o-5,2026-03-05,fb,1,X,a\n")
    c.delivery.listed(window(2))
    one = ["daily_revenue"]
    assert c.load().publish(marts=one) == (True, 2, 0, 0, 1)
    held = c.store.committed("withheld").collect()
    assert [(r.mart, r.source, r.batch_no, r.status, r.day, r.dims) for r in held] == [
        ("daily_revenue", "orders", 2, "not_received", D(2026, 3, 3), "{}")]
    assert c.publish(marts=one) == (False, 0, 0, 2, 1)
    c.delivery.file(window(2)["path"], "what,ever\n")
    assert c.load().publish(marts=one) == (False, 0, 0, 2, 1)
    c.delivery.file(window(2)["path"], order("o-4", "2026-03-04"))
    assert c.load().publish(marts=one) == (True, 2, 0, 2, 0)
    # A later batch is expected over published days: they stay as they are, and the check says so.
    c.delivery.listed({**window(4), "covers_from": "2026-03-03", "covers_to": "2026-03-04"})
    assert c.load().publish(marts=one) == (False, 0, 0, 2, 2)
    assert c.lines() == [
        "acme: 2 findings (3/4 batches loaded, as of 2026-03-06)",
        "  not_received: orders/batch 4 (acme/orders/batch_04.csv, covers through 2026-03-04)",
        "  published_incomplete: daily_revenue has 2 published keys from 2026-03-03 to 2026-03-04 inside orders/batch 4 "
        "(covers 2026-03-03 to 2026-03-04), which has not loaded (not_received)"]


def test_a_run_that_dies_publishes_nothing(spark, tmp_path, monkeypatch):
    c = Client(spark, tmp_path, only_orders()).deliver(window(1), order("o-1", "2026-03-01")).load()
    append = Store.append

    def dies(self, table, df):
        if table == "run":
            raise RuntimeError("lost")
        append(self, table, df)

    monkeypatch.setattr(Store, "append", dies)
    with pytest.raises(RuntimeError):
        c.publish()
    monkeypatch.setattr(Store, "append", append)
    assert reported_metric(c.store).count() == 0
    assert c.publish() == (True, 2, 0, 0, 0)
    assert {r.version for r in c.store.committed("published").collect()} == {1}


def test_findings(spark, tmp_path):
    c = Client(spark, tmp_path, config("acme", sources={
        "orders": {"columnAliases": {}}, "email_events": {"columnAliases": {}, "valueMaps": {"type": {"OPEN": "open"}}},
        "ad_spend": {"columnAliases": {}, "valueMaps": {"platform": {"Meta": "facebook"}}}}))
    c.deliver(window(1), f"{ORDERS}\no-1,2026-03-01,fb,1.00,X,a\no-2,2026-03-01,fb,12.5O,X,a\n,2026-03-01,fb,1,X,a\n")
    c.deliver(window(2), f"{ORDERS}\no-2,2026-03-01,fb,12.50,X,a\n")
    c.deliver(entry("acme", "email_events", 1, "2026-03-01", "2026-03-02"), "\n".join(
        [event(type="OPEN"), event(event_id="e-2", type="BOUNCE"), event(event_id="e-3", type="BOUNCE")]))
    spend = "date,campaign_id,platform,spend"
    c.deliver(entry("acme", "ad_spend", 1, "2026-03-01", "2026-03-02"), "\n".join(
        [spend, "2026-13-45,c,fb,1", "2026-03-01,c,fb,1.O0", "2026-03-02,c,Meta,bad", "2026-03-02,c,facebook,2.00"]))
    c.deliver(entry("acme", "ad_spend", 2, "2026-03-03", "2026-03-04"), "date,campaign_id,platform,spend_eur\n")
    c.deliver(entry("acme", "refunds", 1, "2026-03-01", "2026-03-02"), REFUNDS + "\n")
    c.load()
    c.delivery.file(window(1)["path"], order("o-1", "2026-03-01", "2.00"))
    c.load()
    assert c.lines() == [
        "acme: 10 findings (4/6 batches loaded, as of 2026-03-04)",
        "  conflicting_redelivery: orders/batch 1 is loaded, but a later delivery with different content was quarantined (batch_conflict)",
        "  quarantined: ad_spend/batch 2 (unknown_header, missing_column)",
        "  quarantined: refunds/batch 1 (source_not_configured)",
        "  stale: email_events loaded through 2026-03-02, expected 2026-03-04",
        "  stale: ad_spend loaded through 2026-03-02, expected 2026-03-04",
        "  source_not_configured: the manifest lists refunds, which this tenant has not configured",
        "  invalid_rows: orders.order_id 1 row (first: batch 1 line 4)",
        "  invalid_rows: ad_spend.date 1 row (first: batch 1 line 2)",
        "  invalid_rows: ad_spend.spend 1 row (first: batch 1 line 3)",
        '  uncounted_values: email_events.type "BOUNCE" 2 rows, not one of delivered, open, click, unsubscribe',
        "  note: orders.gross 1 invalid row superseded by a later batch",
        "  note: ad_spend.spend 1 invalid row superseded by a later batch"]
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        c.lines("March")


def test_scope(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "tenant_id string, n int")
    assert [r.n for r in scope.scope(df, "a").collect()] == [1]
    assert scope.scope(df, None).count() == 0
    with pytest.raises(ValueError):
        scope.scope(df, "  ")
    assert scope.checked_for(df.filter("n = 1"), "a").count() == 1
    with pytest.raises(Exception, match="row of another tenant: b"):
        scope.checked_for(df, "a").collect()
    scope.scoped_views(spark, {"things": df})
    assert spark.table("things").count() == 0
    spark.sql("SET VARIABLE current_tenant = 'b'")
    assert [r.n for r in spark.table("things").collect()] == [2]
