"""Files end to end: what each shape of file does, and what a second delivery changes."""

import json
from hashlib import sha256

import pytest
from helpers import ORDERS, REFUNDS, SPEND, Delivery, config, entry
from pyspark.sql import functions as F

from tidemark.operators import staging
from tidemark.plans.load import load
from tidemark.plans.store import Store
from tidemark.sources.lines import MISSING, hash_files
from tidemark.sources.manifest import read_manifest
from tidemark.sources.tenants import control_of, read_tenants, scan_tenants

SEASON = ("2031-05-01", "2031-09-30")
BACK = "K7/{0},2031-06-{0:02d}T08:15:00Z,order {0},{0}.25,SEK"


def refunds(*rows):
    return "\n".join([REFUNDS, *rows]) + "\n"


def loaded(spark, store, delivery):
    results = load(spark, store, read_tenants(spark, delivery.tenants), read_manifest(spark, delivery.manifest), delivery.root)
    return {(r.tenant_id, r.source, r.batch_no): r for r in results.collect()}


def raw_lines(store, source):
    rows = store.read("raw").join(store.read("ledger"), ["tenant_id", "batch_file_id", "source"]).filter(f"source = '{source}'")
    return sorted((r.batch_no, r.line_no, r.payload) for r in rows.select("batch_no", "line_no", "payload").collect())


def put(delivery, tenant, source, batch, content, path=None):
    e = entry(tenant, source, batch, *SEASON, path=path)
    delivery.listed(e)
    return delivery if content is None else delivery.file(e["path"], content)


# What a refunds file of the quay's shop does: its content -> (status, codes with lines, lines of its rows).
CSV_CASES = {
    "plain": (refunds(BACK.format(11)), "loaded", [], [2]),
    "no end": (refunds(BACK.format(12))[:-1], "loaded", [], [2]),
    "windows": (refunds(BACK.format(13)).replace("\n", "\r\n"), "loaded", [], [2]),
    "marked": ("﻿" + refunds(BACK.format(14)), "loaded", [], [2]),
    "blank end": (refunds(BACK.format(15)) + "\n\r\n\n", "loaded", [], [2]),
    "mark later": (refunds(BACK.format(16)) + "﻿\n", "quarantined", [("column_count", 3)], []),
    "bare return": (refunds(BACK.format(17)) + "\r", "quarantined", [("column_count", 3)], []),
    "hole": (refunds("", BACK.format(18)), "quarantined", [("column_count", 2)], []),
    "address": (refunds('"K7/19","Pier 4\nBerth 2\n\nHarbour",o,1,SEK', BACK.format(20)), "loaded", [], [2, 6]),
    "short after long": (refunds('"K7/21","Pier\n5",o,1,SEK', "K7/22,x,o,2"), "quarantined", [("column_count", 4)], []),
    "inch": (refunds('K7/23,5"x7",o,1,SEK'), "quarantined", [("malformed_csv", None)], []),
    "never closed": (refunds(f'"{BACK.format(24)}', BACK.format(25)), "quarantined", [("malformed_csv", None)], []),
    "latin": (refunds(BACK.format(26)).encode() + "Malmö".encode("latin-1"), "quarantined", [("invalid_encoding", None)], []),
    "nothing": ("", "quarantined", [("empty_file", None)], []),
    "only a mark": ("﻿\r\n", "quarantined", [("empty_file", None)], []),
    "columns": ("amount,currency,currency,berth,refund_id\n", "quarantined", [
        ("duplicate_header", None), ("missing_column", None), ("missing_column", None), ("unknown_header", None)], []),
}


@pytest.fixture(scope="module")
def quay(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("quay")
    d = Delivery(base / "d").tenant(config("quay", "SEK"))
    for n, (content, *_) in enumerate(CSV_CASES.values(), 1):
        put(d, "quay", "refunds", n, content)
    store = Store(spark, str(base / "store"))
    return loaded(spark, store, d), raw_lines(store, "refunds")


@pytest.mark.parametrize("number,name", list(enumerate(CSV_CASES, 1)))
def test_shapes_of_csv_files(quay, number, name):
    results, rows = quay
    _, status, codes, lines = CSV_CASES[name]
    got = results[("quay", "refunds", number)]
    assert (got.status, sorted(((r.code, r.line) for r in got.reasons or []), key=str)) == (status, sorted(codes, key=str))
    assert [line for batch, line, _ in rows if batch == number] == lines
    assert got.row_count == (len(lines) if status == "loaded" else None)


def test_fields_of_csv_rows(quay):
    _, rows = quay
    number = list(CSV_CASES).index("address") + 1
    first = next(payload for batch, _, payload in rows if batch == number)
    assert first["refunded_at"] == "Pier 4\nBerth 2\n\nHarbour" and first["refund_id"] == "K7/19"


def test_long_lists_of_problems_are_counted(spark, tmp_path):
    wrong = ",".join(f"berth {n} {'~' * 120}" for n in range(27))
    d = put(Delivery(tmp_path / "d").tenant(config("quay")), "quay", "ad_spend", 1, f"{SPEND},{wrong}\n")
    reasons = loaded(spark, Store(spark, str(tmp_path / "store")), d)[("quay", "ad_spend", 1)].reasons
    assert [r.code for r in reasons] == ["unknown_header"] * 20 + ["truncated"]
    assert reasons[20].message == "7 more problems not listed"
    assert ("berth 0 " + "~" * 92 + "…") in reasons[0].message


def test_declared_headers(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("quay", sources={"ad_spend": {"columnAliases": {"spend": ["fee"], "platform": ["board"]}}}))
    put(d, "quay", "ad_spend", 1, "fee,board,campaign_id,date\n7.5,north pier,regatta,2031-07-02\n")
    put(d, "quay", "ad_spend", 2, f"{SPEND},board\n2031-07-03,regatta,east,1,west\n")
    got = loaded(spark, store := Store(spark, str(tmp_path / "store")), d)
    assert got[("quay", "ad_spend", 1)].adapted == {"fee": "spend", "board": "platform"}
    assert raw_lines(store, "ad_spend")[0][2] == {"fee": "7.5", "board": "north pier", "campaign_id": "regatta", "date": "2031-07-02"}
    assert [r.message for r in got[("quay", "ad_spend", 2)].reasons] == ['headers "platform" and "board" both map to column "platform"']


def mail(**fields):
    return json.dumps({"event_id": "gull-1", "type": "delivered", "email": "mate@quay.invalid", "campaign_id": "regatta", "occurred_at": "2031-06-01", **fields})


def test_json_lines(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("quay", sources={"email_events": {"columnAliases": {"type": ["kind"]}}}))
    good = [
        mail(event_id=7), mail(email=None, event_id=True), mail().replace('"type"', '"kind"'),
        mail().replace('"gull-1"', "12.50").replace('"regatta"', "4e2").replace('"2031-06-01"', '"2.0"'),
        mail()[:-1] + ', "email": "bosun@quay.invalid"}', mail(campaign_id={"b": [1.50, 2]})]
    put(d, "quay", "email_events", 1, "\n".join(good) + "\n\r\n")
    put(d, "quay", "email_events", 2, "\n".join([mail(), " ", "12", mail() + mail(), mail()[1:], mail(tide="high")]))
    put(d, "quay", "email_events", 3, "\n".join("][" for _ in range(23)))
    got = loaded(spark, store := Store(spark, str(tmp_path / "store")), d)
    rows = [payload for _, _, payload in raw_lines(store, "email_events")]
    assert [r["event_id"] for r in rows] == ["7", "true", "gull-1", "12.5", "gull-1", "gull-1"]
    assert (rows[1]["email"], rows[2]["kind"], rows[3]["campaign_id"], rows[3]["occurred_at"]) == (None, "delivered", "400", "2.0")
    assert rows[4]["email"] == "bosun@quay.invalid" and rows[5]["campaign_id"] == '{"b":[1.5,2]}'
    assert [(r.code, r.line) for r in got[("quay", "email_events", 2)].reasons] == [
        ("empty_line", 2), ("not_an_object", 3), ("invalid_json", 4), ("invalid_json", 5), ("unknown_header", 6)]
    assert got[("quay", "email_events", 3)].reasons[-1].message == "3 more problems not listed"


def test_splits_do_not_change_line_numbers(spark, tmp_path):
    rows, want, line = [ORDERS], [], 2
    for n in range(250):
        note = 'said ""ahoy"",\nthen, again\n' if n % 9 == 4 else "calm"
        rows.append(f'"log {n}",2031-08-01,"{note}",{n},SEK,mate')
        want.append((line, f"log {n}"))
        line += 1 + note.count("\n")
    d = put(Delivery(tmp_path / "d").tenant(config("quay")), "quay", "orders", 1, "\n".join(rows))
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        loaded(spark, store := Store(spark, str(tmp_path / "store")), d)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert [(line, payload["order_id"]) for _, line, payload in raw_lines(store, "orders")] == want


def test_second_deliveries(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("quay", sources={"refunds": {"columnAliases": {}}, "ad_spend": {"columnAliases": {}}})).tenant(config("mole"))
    same, fee = refunds(BACK.format(5)), "date,campaign_id,platform,fee\n2031-07-01,regatta,pier,9\n"
    for tenant, source, batch, content in [
            ("quay", "refunds", 4, same), ("quay", "refunds", 9, same), ("quay", "refunds", 12, None), ("quay", "ad_spend", 1, fee),
            ("quay", "orders", 1, ORDERS + "\n"), ("mole", "refunds", 1, same), ("dune", "refunds", 1, same)]:
        put(d, tenant, source, batch, content)
    store = Store(spark, str(tmp_path / "store"))
    got = loaded(spark, store, d)
    assert {k: r.status for k, r in got.items()} == {
        ("quay", "refunds", 4): "loaded", ("quay", "refunds", 9): "quarantined", ("quay", "refunds", 12): "missing", ("quay", "ad_spend", 1): "quarantined",
        ("quay", "orders", 1): "quarantined", ("mole", "refunds", 1): "loaded"}
    assert [r.code for r in got[("quay", "orders", 1)].reasons] == ["source_not_configured"]
    assert "batch 4" in got[("quay", "refunds", 9)].reasons[0].message

    # A declared header cures the spend file; new bytes for batch 9 are its first load, for batch 4 a conflict.
    d.tenant(config("quay", sources={"refunds": {"columnAliases": {}}, "ad_spend": {"columnAliases": {"spend": ["fee"]}}}))
    d.file("quay/refunds/batch_09.csv", refunds(BACK.format(9))).file("quay/refunds/batch_04.csv", refunds(BACK.format(4)))
    d.file("quay/refunds/batch_12.csv", same)
    got = loaded(spark, store, d)
    assert {k[1:]: (r.status, [x.code for x in r.reasons or []]) for k, r in got.items() if k[0] == "quay"} == {
        ("refunds", 4): ("quarantined", ["batch_conflict"]), ("refunds", 9): ("loaded", []), ("refunds", 12): ("quarantined", ["duplicate_content"]),
        ("ad_spend", 1): ("loaded", []), ("orders", 1): ("quarantined", ["source_not_configured"])}
    assert (got[("mole", "refunds", 1)].status, got[("mole", "refunds", 1)].row_count) == ("skipped", 1)
    assert store.read("ledger").filter("status = 'loaded'").select("batch_file_id").distinct().count() == 4


def test_one_bad_file_holds_up_its_own_tenant_only(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("quay")).tenant(config("mole"))
    put(d, "quay", "ad_spend", 1, f"{SPEND}\n2031-07-01,regatta,pier,9\n")
    put(d, "quay", "orders", 1, ORDERS + "\n", path="quay/orders/_first.csv")
    put(d, "quay", "refunds", 1, refunds(BACK.format(3)))
    put(d, "mole", "refunds", 1, refunds(BACK.format(6)), path="mole/refunds/part[1] {a}*.csv")
    got = loaded(spark, Store(spark, str(tmp_path / "store")), d)
    assert {k: r.status for k, r in got.items()} == {
        ("quay", "ad_spend", 1): "loaded", ("quay", "orders", 1): "failed", ("quay", "refunds", 1): "blocked", ("mole", "refunds", 1): "loaded"}
    assert got[("quay", "orders", 1)].reasons[0].code == "failed"


def test_nothing_loads_when_a_path_leaves_its_folder_or_a_job_dies(spark, tmp_path, monkeypatch):
    d = put(Delivery(tmp_path / "d").tenant(config("quay")), "quay", "refunds", 1, refunds(BACK.format(2)))
    store = Store(spark, str(tmp_path / "store"))
    append = Store.append

    def dies(self, table, df):
        if table == "ledger":
            raise RuntimeError("cut off")
        append(self, table, df)

    monkeypatch.setattr(Store, "append", dies)
    with pytest.raises(RuntimeError):
        loaded(spark, store, d)
    monkeypatch.setattr(Store, "append", append)
    assert staging.loaded_record(store.read("raw"), store.read("ledger")).count() == 0
    assert loaded(spark, store, d)[("quay", "refunds", 1)].status == "loaded"
    assert staging.loaded_record(store.read("raw"), store.read("ledger")).count() == 1
    assert store.read("raw").select("batch_file_id").distinct().count() == 2
    put(d, "quay", "refunds", 2, None, path="quay/../mole/all.csv")
    with pytest.raises(ValueError, match="outside fixtures/quay"):
        loaded(spark, store, d)
    with pytest.raises(ValueError, match="append-only"):
        store.replace("raw", store.read("raw"))


def test_repeated_keys_of_a_tenant_file(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("quay"))
    d.tenant('{"id": "mole", "displayName": "Mole", "currency": "DKK", "fixturesDir": "fixtures/mole", "sources": {"orders": {"columnAliases": {}}, '
             '"orders": {"columnAliases": {}, "valueMaps": {"channel": {"pier": "web", "pier": "shop"}}}}}', "mole")
    control = control_of(scan_tenants(spark, d.tenants))
    assert [(r.raw_value, r.canonical_value) for r in control.value_map.collect()] == [("pier", "shop")]
    assert control.configured.filter("tenant_id = 'mole'").count() == 1


def test_every_problem_is_counted(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("quay"))
    d.listed(*[entry("quay", "orders", n, "2031-05-02", "2031-05-01") for n in range(1, 104)])
    with pytest.raises(ValueError, match="and 3 more, all in "):
        read_manifest(spark, d.manifest)


def test_files_are_hashed_by_many_tasks(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"f{k}").write_bytes(b"x" * k)
    files = spark.createDataFrame([(f"{tmp_path}/f{k}",) for k in range(60)] * 2 + [(f"{tmp_path}/none",)], "file string")
    rows = hash_files(files).withColumn("task", F.spark_partition_id()).collect()
    assert {r.file: (r.bytes, r.sha256) for r in rows if r.error is None} == {f"{tmp_path}/f{k}": (k, sha256(b"x" * k).hexdigest()) for k in range(60)}
    assert len(rows) == 61 and [r.error for r in rows if r.error] == [MISSING]
    assert len({r.task for r in rows}) > 4
