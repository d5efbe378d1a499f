"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.session import materialize


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Connect every node's neighbours (only larger ones, or all of them) to its least neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumn(
        "least", F.least("u", "least")
    )
    joined = edges.join(least, "u")
    if larger_only:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
        least.select("u", F.col("least").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the least node of its component, for all nodes of ``edges`` (u, v: long).

    Large and small stars alternate until the edges are stars around least nodes, after about the
    squared logarithm of the largest component. A step aggregates per node before it joins, never
    holds a component in one task, and brings only a count and a checksum to the driver.
    """
    edges = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, larger_only=True).where("u <> v").distinct()
        edges = materialize(_star(large, larger_only=False).where("u <> v").distinct())
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
