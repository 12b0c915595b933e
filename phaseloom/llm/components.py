"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phaseloom.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (u, v) with u > v."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    near = both.join(least, "u")  # of two tables as they are, so adaptive execution splits a hub's edges
    moved = near.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.where("m < u").select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label for each node of edges (a, b): label is the smallest node that it reaches.

    Large-star and small-star steps alternate until every edge joins a node to its label, which takes about
    log(nodes) rounds however long a chain is. Each round is stored; the smallest neighbour is found with map-side
    combining and stored, and the join that gives it to a hub's edges is one that adaptive execution splits.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while True:
        step = stored(_star(stored(_star(now, True), "large-star"), False), "small-star")
        # a forest of depth one: nobody is both a node with a label and a label, and nobody has two labels
        roots = step.select(F.col("v").alias("u"))
        n, nodes = step.agg(F.count(F.lit(1)), F.countDistinct("u")).first()
        if n == nodes and step.join(roots, "u", "left_semi").isEmpty():
            labels = step.select(F.col("u").alias("node"), F.col("v").alias("label"))
            return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
        now = step
