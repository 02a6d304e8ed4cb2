"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (a, b: no nulls, any orderable type).

    Each round hangs every node below its smallest neighbour, shortens the chains that result, and
    replaces nodes by what they hang below; edges inside a tree vanish. Node counts at least halve, so rounds
    grow with the logarithm of the graph. Every step is a grouping with a map-side minimum or an equi join, whatever a node's degree.
    Every round is written to the shared folder.
    """
    edges = stored(edges.select("a", "b").filter("a != b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")).withColumnRenamed("a", "node")
        parent = stored(parent, "parents")
        for _ in range(2):  # a grandparent's parent: a chain shrinks to a quarter
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = parent.join(above, "up").select("node", F.col("top").alias("up"))
        parent = stored(parent, "parents")
        a = parent.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = parent.select(F.col("node").alias("b"), F.col("up").alias("y"))
        edges = edges.join(a, "a").join(b, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = stored(edges.filter("a != b").distinct(), "edges")
        if labels is None:
            labels = parent.select("node", F.col("up").alias("component"))
        else:
            step = parent.select(F.col("node").alias("component"), "up")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            labels = stored(labels, "labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
