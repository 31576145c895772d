"""Publishing: snapshot the marts, hold back incomplete days, append versions and restatements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contract import MARTS, check_marts
from tidemark.functions.values import reader_width
from tidemark.operators import marts as mart_ops, publishing
from tidemark.operators.coverage import incomplete_windows
from tidemark.operators.staging import STAGING
from tidemark.plans.store import Store
from tidemark.session import cut, cut_all


def stage(store: Store, ledger: DataFrame, sources: list[str]) -> dict[str, DataFrame]:
    """Staging relations of the files in `ledger`, each computed once."""
    raw, value_map, width = store.read("raw"), store.read("value_map"), reader_width(ledger)
    staged = cut_all({s: STAGING[s](raw, ledger, value_map, width) for s in sources if s != "refunds"} or {"ledger": ledger})
    if "refunds" in sources:
        # Staged orders have one row a key, so they need not be read and made distinct again.
        known = staged["orders"].select("tenant_id", "order_id") if "orders" in sources else None
        staged["refunds"] = cut(STAGING["refunds"](raw, ledger, value_map, width, known_orders=known), "refunds")
    return {s: staged[s] for s in sources}


def publish(spark: SparkSession, store: Store, manifest: DataFrame, marts: list[str] | None = None) -> DataFrame:
    """Publish what changed for every tenant in one run; per tenant what was done.

    Marts, lineage, loaded files and completeness all come from one copy of the ledger, so a file that is
    loaded meanwhile is in all of them or in none. Versions, restatements and what was withheld are
    written first and the run rows last; readers follow run rows, so a run that dies has published
    nothing. A tenant with no new version gets no run row. One publishing job at a time.
    """
    names = check_marts(marts)
    ledger = cut(store.read("ledger"), "ledger")
    tenants = store.read("tenant")
    expected = manifest.join(tenants.select("tenant_id"), "tenant_id", "left_semi")
    sources = [s for s in STAGING if any(f.source == s for m in names for f in MARTS[m].feeds)]
    staged = stage(store, ledger, sources)
    current = publishing.mart_keys(mart_ops.build(staged, tenants, names))
    latest = publishing.latest_published(store.committed("published").filter(F.col("mart").isin(names)))
    windows = cut(incomplete_windows(expected, ledger), "windows")
    done = cut(publishing.classify(current, latest, windows, names), "classified")
    totals = publishing.summary(done)

    run_id = store.claim(store.max_id("run", "run_id"))
    writing = cut(totals.filter("published > 0").select("tenant_id"), "writing")
    result = tenants.select("tenant_id").join(totals, "tenant_id", "left").select(
        "tenant_id", F.when(F.col("published") > 0, F.lit(run_id)).alias("run_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("published", "restated", "unchanged", "withheld")])
    if writing.isEmpty():
        return result

    def in_run(df: DataFrame) -> DataFrame:
        return df.join(writing, "tenant_id", "left_semi").withColumn("run_id", F.lit(run_id))

    loaded = ledger.filter("status = 'loaded'")
    changed = publishing.causes(
        publishing.changed(done), publishing.lineage(staged, names), store.committed("run_file"), loaded)
    store.append("published", in_run(publishing.new_versions(done)))
    store.append("restatement", in_run(changed))
    store.append("withheld", in_run(publishing.withheld_keys(done, windows, names)))
    store.append("run_file", in_run(loaded.select("tenant_id", "batch_file_id")))
    store.append("run", in_run(writing).withColumn("published_at", F.current_timestamp()))
    return result


def reported_metric(store: Store) -> DataFrame:
    """What every tenant was last told."""
    times = store.read("run").select("tenant_id", "run_id", "published_at")
    return publishing.reported_metric(store.committed("published")).join(times, ["tenant_id", "run_id"])


def history(store: Store) -> DataFrame:
    return publishing.history(store.committed("published"), store.committed("restatement"), store.read("ledger"))
