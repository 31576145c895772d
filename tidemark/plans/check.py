"""The health check: batches, findings and notes of every tenant, read only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.contract import CLOSED_VALUES, ISO_DATE
from tidemark.functions.values import reader_width
from tidemark.operators import health, publishing, quality
from tidemark.operators.coverage import incomplete_windows
from tidemark.operators.staging import STAGING
from tidemark.plans.store import Store
from tidemark.session import cut, cut_all
from tidemark.sources.tenants import Control


@dataclass(frozen=True)
class Health:
    batches: DataFrame
    freshness: DataFrame
    findings: DataFrame
    notes: DataFrame
    lines: DataFrame

    def exit_status(self) -> int:
        return health.exit_status(self.findings)


def check(spark: SparkSession, store: Store, control: Control, manifest: DataFrame, as_of: str | None = None) -> Health:
    if as_of is not None and not re.match(ISO_DATE, as_of):
        raise ValueError(f'as_of must be YYYY-MM-DD, got "{as_of}"')
    tenants = control.tenant.select("tenant_id")
    expected = cut(manifest.join(tenants, "tenant_id", "left_semi"), "expected")
    configured = cut(control.configured, "configured")
    ledger = cut(store.read("ledger").join(tenants, "tenant_id", "left_semi"), "ledger")
    raw, value_map, width = store.read("raw"), store.read("value_map"), reader_width(ledger)

    lines = cut_all(quality.checked_all(raw, ledger, value_map, width))
    current = cut(quality.current_invalid_rows(lines), "current_invalid")
    superseded = quality.superseded_counts(quality.invalid_rows(lines), current)
    closed = {s: STAGING[s](raw, ledger, value_map, width) for s, _ in CLOSED_VALUES}
    windows = cut(incomplete_windows(expected, ledger), "windows")
    reported = publishing.reported_metric(store.committed("published"))

    found = cut(health.findings(
        expected, ledger, configured, windows, reported, current, quality.uncounted_values(closed), as_of), "findings")
    noted = cut(health.notes(ledger, superseded), "notes")
    return Health(
        batches=health.batch_health(expected, ledger),
        freshness=health.freshness(expected, ledger, configured, as_of),
        findings=found, notes=noted,
        lines=health.report_lines(tenants, expected, ledger, found, noted, as_of))
