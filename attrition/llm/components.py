"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import materialize


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``links`` (columns a, b).

    Each step replaces a node's links by links to its smallest neighbour, so the
    graph contracts to stars in O(log n) rounds.  A round is written as Parquet
    in the shared folder, which cuts the lineage; only a count and a checksum
    reach the driver.  A node with very many links is one side of a join that
    adaptive execution splits; its minimum is pre-aggregated before the shuffle.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "components")
    seen = _checksum(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = materialize(small.distinct(), "components")
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
