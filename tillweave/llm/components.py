"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm.shared import settled


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges a > b; minima are pre-aggregated and joined back."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = low.filter("a > m").select("a", F.col("m").alias("b"))
        return moved.unionByName(kept).filter("a != b").distinct()
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter("b != m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of links (a, b); null ends are left out."""
    edges = links.filter("a is not null and b is not null and a != b")
    edges = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        edges = settled(_star(_star(edges, True), False))
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        mark = seen
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
