"""Small deliveries on disk."""

import json
import os

ORDERS = "order_id,created_at,channel,gross,currency,customer_email"
SPEND = "date,campaign_id,platform,spend"
REFUNDS = "refund_id,refunded_at,order_id,amount,currency"


def event(**changes):
    row = {"event_id": "e-1", "type": "open", "email": "a@example.invalid", "campaign_id": "c", "occurred_at": "2026-03-01T10:00:00Z"}
    row.update(changes)
    return json.dumps(row)


def config(tenant_id, currency="GBP", sources=None):
    plain = {s: {"columnAliases": {}} for s in ("orders", "email_events", "ad_spend", "refunds")}
    return {
        "id": tenant_id, "displayName": tenant_id.title(), "currency": currency, "fixturesDir": f"fixtures/{tenant_id}",
        "sources": plain if sources is None else sources}


def entry(tenant, source, batch, covers_from, covers_to, path=None):
    ending = "ndjson" if source == "email_events" else "csv"
    return {
        "tenant": tenant, "source": source, "batch": batch, "covers_from": covers_from, "covers_to": covers_to,
        "path": path or f"{tenant}/{source}/batch_{batch:02d}.{ending}"}


class Delivery:
    """A delivery folder: tenants/*.json, fixtures/manifest.json and fixtures/<tenant>/<source>/..."""

    def __init__(self, root):
        self.root = str(root)
        self.tenants = f"{self.root}/tenants"
        self.manifest = f"{self.root}/fixtures/manifest.json"
        self.entries = []
        os.makedirs(self.tenants)
        os.makedirs(f"{self.root}/fixtures")

    def tenant(self, body, name=None):
        with open(f"{self.tenants}/{name or body['id']}.json", "w") as f:
            f.write(body if isinstance(body, str) else json.dumps(body))
        return self

    def listed(self, *entries):
        self.entries.extend(entries)
        with open(self.manifest, "w") as f:
            json.dump({"batches": self.entries}, f)
        return self

    def file(self, path, content):
        full = f"{self.root}/fixtures/{path}"
        os.makedirs(os.path.dirname(full), exist_ok=True)
        data = content if isinstance(content, bytes) else content.encode()
        with open(full, "wb") as f:
            f.write(data)
        return self
