"""Connected components by alternating large-star and small-star steps.

Every step is a map-side-combined minimum per node and one join; edges and
labels stay distributed, each step's result is a written table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.llm.common import staged


def _star(edges: DataFrame, small: bool, name: str) -> DataFrame:
    """Link neighbours to the least node of the neighbourhood."""
    if small:  # from each node to its smaller neighbours and itself
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = staged(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}_least")
    linked = near.join(least, "u")
    if small:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return staged(out.filter(F.col("a") != F.col("b")).distinct(), name)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b`` longs); root = least node."""
    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = staged(edges.filter(F.col("a") != F.col("b")).distinct(), "cc_edges")
    before = state(edges)
    while before[0]:
        edges = _star(_star(edges, False, "cc_large"), True, "cc_small")
        now = state(edges)
        if now == before:
            break
        before = now
    # at the fixed point every edge joins a node to its root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
