"""Continuous arrival: a file stream over the landing folder that runs the same load for what arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.load import load, located
from tidemark.plans.store import Store
from tidemark.session import cut
from tidemark.sources.manifest import read_manifest
from tidemark.sources.paths import plain
from tidemark.sources.tenants import read_tenants

ARRIVALS = "path string, modificationTime timestamp, length bigint, content binary"


def load_stream(
    spark: SparkSession, store: Store, root: str, checkpoint: str, delivery_root: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start loading files as they land; `trigger` defaults to everything there now, then stop.

    Each micro-batch loads the manifest entries whose files are in it. Configuration and manifest are read
    again every time. Whether a file is new is decided by the ledger, not by the stream's checkpoint, so a
    replayed micro-batch only skips.
    """
    landing = delivery_root or f"{root.rstrip('/')}/fixtures"
    arrived = (
        spark.readStream.format("binaryFile").schema(ARRIVALS).option("recursiveFileLookup", True)
        .load(landing).select(plain(F.col("path")).alias("file")))

    def on_batch(files: DataFrame, batch_id: int) -> None:
        here = cut(files.distinct(), "arrived")
        control = read_tenants(spark, f"{root.rstrip('/')}/tenants")
        manifest = read_manifest(spark, f"{landing}/manifest.json")
        entries = located(manifest, control, root, landing).join(here, "file", "left_semi")
        now = cut(entries.select(manifest.columns), "entries")
        if not now.isEmpty():
            load(spark, store, control, now, root, landing)

    return (
        arrived.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start())
