"""Reachability over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import components as connected
from lakeloom.plans import durable


def reachable(edges: DataFrame, start: DataFrame, max_hops: int) -> DataFrame:
    """Nodes reachable from ``start`` (column ``node``) with their least hop count.

    One frontier join per hop; nodes seen before are dropped, so cycles end by themselves and the
    work per hop is bounded by the edges and not by the number of paths.
    """
    links = edges.select("source", "target").distinct()
    frontier = start.select("node").distinct()
    seen = frontier.withColumn("hops", F.lit(0).cast("bigint"))
    for hop in range(1, max_hops + 1):
        nxt = (
            links.join(frontier, F.col("source") == F.col("node"), "left_semi")
            .select(F.col("target").alias("node")).distinct()
            .join(seen.select("node"), "node", "left_anti")
        )
        frontier = durable.cut(nxt, "frontier")
        seen = seen.unionByName(frontier.withColumn("hops", F.lit(hop).cast("bigint")))
    return seen.filter("hops > 0")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) where the component is named by its lowest node; see ``plans.components``."""
    return connected.components(edges).withColumnRenamed("root", "component")
