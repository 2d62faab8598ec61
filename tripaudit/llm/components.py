"""Connected components by repeated contraction, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.llm.common import keep


def _parents(edges: DataFrame) -> DataFrame:
    """``node, parent``: the smallest neighbour if smaller than the node, followed two steps."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    parents = both.groupBy("node").agg(F.min("other").alias("parent")).withColumn("parent", F.least("node", "parent"))
    for _ in range(2):
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        parents = parents.join(up, "parent").select("node", F.col("up").alias("parent"))
    return parents


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component is its smallest node.

    A round merges every node into a smaller neighbour and keeps the links
    between what is left, at most half of the nodes per component, so rounds
    grow with the logarithm of a component's size. Links of a node to itself
    and repeated links do no harm; nodes are never null.
    """
    edges = keep(edges.select("a", "b").distinct(), "edges")
    labels = None
    while True:
        parents = keep(_parents(edges), "parents").select(F.col("node"), F.col("parent").alias("component"))
        if labels is None:
            labels = parents
        else:
            step = parents.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            labels = labels.join(step, "component", "left").select("node", F.coalesce("_next", "component").alias("component"))
        a = parents.select(F.col("node").alias("a"), F.col("component").alias("_a"))
        b = parents.select(F.col("node").alias("b"), F.col("component").alias("_b"))
        left = edges.join(a, "a").join(b, "b").where(F.col("_a") != F.col("_b"))
        edges = keep(left.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
