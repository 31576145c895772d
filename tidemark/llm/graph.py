"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import cut


def _lowest(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge: component is the smallest node reachable.

    Each round points every node at the smallest one near it; paths shorten by a constant factor, so the number of
    rounds grows with the logarithm of the longest path. Each round is written to the shared folder, which cuts the
    lineage. Edges are joined on their node with its minimum, one row a node, so a hub's edges can be split by AQE.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = cut(e, "edges")
    mark = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).select(F.struct("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").withColumn("k", F.struct("u")).join(low, "k").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        low = _lowest(large).select(F.struct("u").alias("k"), "m")
        joined = large.withColumn("k", F.struct("u")).join(low, "k")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(joined.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small, "edges")
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
