"""What every delivery must look like: sources, columns, keys, marts and table schemas."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. They are the data contract and must not be changed to fit data.
# ---------------------------------------------------------------------------
SOURCE_COLUMNS: dict[str, list[str]] = {
    "orders": ["order_id", "created_at", "channel", "gross", "currency", "customer_email"],
    "email_events": ["event_id", "type", "email", "campaign_id", "occurred_at"],
    "ad_spend": ["date", "campaign_id", "platform", "spend"],
    "refunds": ["refund_id", "refunded_at", "order_id", "amount", "currency"],
}
SOURCES = list(SOURCE_COLUMNS)
SOURCE_FORMAT = {"orders": "csv", "email_events": "ndjson", "ad_spend": "csv", "refunds": "csv"}

# Required columns and how their text is read.
REQUIRED: dict[str, dict[str, str]] = {
    "orders": {"order_id": "text", "created_at": "timestamptz", "channel": "text", "gross": "numeric"},
    "email_events": {"event_id": "text", "type": "text", "occurred_at": "timestamptz"},
    "ad_spend": {"date": "date", "campaign_id": "text", "platform": "text", "spend": "numeric"},
    "refunds": {"refund_id": "text", "refunded_at": "timestamptz", "order_id": "text", "amount": "numeric"},
}
NATURAL_KEY = {
    "orders": ["order_id"],
    "email_events": ["event_id"],
    "ad_spend": ["date", "campaign_id", "platform"],
    "refunds": ["refund_id"],
}
# Columns whose values go through the tenant's value map, and those with a closed set of values.
MAPPED_COLUMNS = {"orders": ["channel"], "email_events": ["type"], "ad_spend": ["platform"], "refunds": []}
CLOSED_VALUES = {("email_events", "type"): ["delivered", "open", "click", "unsubscribe"]}
# The two open columns that meet in channel performance.
REVENUE_CHANNEL = ("orders", "channel")
SPEND_CHANNEL = ("ad_spend", "platform")

REASON_CODES = [
    "unknown_header", "missing_column", "ambiguous_column", "duplicate_header", "column_count",
    "malformed_csv", "invalid_json", "not_an_object", "empty_line", "empty_file",
    "invalid_encoding", "source_not_configured", "batch_conflict", "duplicate_content", "truncated",
]
MAX_REASONS = 20
MAX_QUOTED = 100
TENANT_ID = r"^[a-z][a-z0-9_]{1,62}$"
CURRENCY = r"^[A-Z]{3}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([ T]|$)"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """One staging relation feeding a mart: its day column and mart dimension -> staging column."""

    source: str
    day: str
    dims: dict[str, str]


@dataclass(frozen=True)
class Mart:
    dims: list[str]
    metrics: list[str]
    feeds: list[Feed]


MARTS: dict[str, Mart] = {
    "daily_revenue": Mart(
        [],
        ["orders", "gross", "refunds", "net", "orphan_refund_count", "orphan_refund_amount"],
        [Feed("orders", "order_date", {}), Feed("refunds", "refund_date", {})],
    ),
    "daily_ad_spend": Mart(["platform"], ["spend"], [Feed("ad_spend", "spend_date", {"platform": "platform"})]),
    "daily_email_engagement": Mart(
        [], ["delivered", "opens", "clicks", "unsubscribes"], [Feed("email_events", "event_date", {})]
    ),
    "daily_channel_performance": Mart(
        ["channel"],
        ["revenue", "spend", "roas"],
        [Feed("orders", "order_date", {"channel": "channel"}), Feed("ad_spend", "spend_date", {"channel": "platform"})],
    ),
}


def marts_fed_by(source: str) -> list[str]:
    return [name for name, mart in MARTS.items() if any(f.source == source for f in mart.feeds)]


def check_marts(marts: list[str] | None) -> list[str]:
    """The requested marts; an empty or unknown list is refused."""
    if marts is None:
        return list(MARTS)
    if not marts:
        raise ValueError("marts must list at least one mart")
    unknown = [m for m in marts if m not in MARTS]
    if unknown:
        raise ValueError("Unknown marts: " + ", ".join(unknown))
    return list(marts)


# Amounts keep up to 20 digits before and 18 after the point; totals are published with six digits after it.
AMOUNT = "decimal(38,18)"
TOTAL = "decimal(38,6)"

REASON_TYPE = "struct<code:string,message:string,line:int>"
REASONS_TYPE = f"array<{REASON_TYPE}>"

# Control tables, the append-only ledger and raw layer, and the append-only publication tables.
TABLES: dict[str, str] = {
    "tenant": "tenant_id string, display_name string, currency string",
    "value_map": "tenant_id string, source string, column_name string, raw_value string, canonical_value string",
    "ledger": (
        "batch_file_id bigint, source string, batch_no int, path string, sha256 string, status string, "
        f"row_count bigint, columns map<string,string>, reasons {REASONS_TYPE}, loaded_at timestamp, tenant_id string"
    ),
    "raw": "batch_file_id bigint, line_no int, payload map<string,string>, tenant_id string, source string",
    "run": "run_id bigint, published_at timestamp, tenant_id string",
    "run_file": "run_id bigint, batch_file_id bigint, tenant_id string",
    "withheld": (
        "run_id bigint, mart string, source string, batch_no int, path string, covers_from string, "
        "covers_to string, status string, day date, dims string, tenant_id string"
    ),
    "published": (
        "run_id bigint, mart string, day date, dims string, version int, metrics string, tenant_id string"
    ),
    "restatement": (
        "run_id bigint, mart string, day date, dims string, from_version int, to_version int, "
        "before string, after string, caused_by array<bigint>, tenant_id string"
    ),
}
PARTITIONS = {
    "tenant": [], "value_map": ["tenant_id"], "ledger": ["tenant_id"], "raw": ["tenant_id", "source"],
    "run": ["tenant_id"], "run_file": ["tenant_id"], "withheld": ["tenant_id"],
    "published": ["tenant_id"], "restatement": ["tenant_id"],
}
APPEND_ONLY = ["ledger", "raw", "run", "run_file", "withheld", "published", "restatement"]

MANIFEST_SCHEMA = (
    "batches array<struct<tenant:string,source:string,batch:bigint,path:string,covers_from:string,covers_to:string>>"
)
