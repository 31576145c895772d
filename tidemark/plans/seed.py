"""Making the stored tenants and value maps equal to the configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.control import merged_tenants, tenant_changes, value_map_changes
from tidemark.plans.store import Store
from tidemark.session import cut
from tidemark.sources.tenants import Control


def sync_control(control: Control, store: Store) -> DataFrame:
    """Upsert every configured tenant and replace its value map; the changed tenant ids.

    Value maps of tenants that are not configured stay. Nothing is written when nothing changed.
    """
    tenants = control.tenant.select("tenant_id")
    stored_map = store.read("value_map").join(tenants, "tenant_id", "left_semi")
    rows = tenant_changes(store.read("tenant"), control.tenant)
    maps = value_map_changes(stored_map, control.value_map)
    changed = cut(rows.select("tenant_id").unionByName(maps.select("tenant_id")).distinct(), "changed")
    if changed.isEmpty():
        return changed
    others = store.read("value_map").join(tenants, "tenant_id", "left_anti")
    # Cut first: a table cannot be replaced by something still reading it.
    new_tenants = cut(merged_tenants(store.read("tenant"), control.tenant), "tenant")
    new_map = cut(others.unionByName(control.value_map.select(others.columns)), "value_map")
    store.replace("tenant", new_tenants)
    store.replace_all("value_map", new_map)
    return changed.orderBy("tenant_id")
