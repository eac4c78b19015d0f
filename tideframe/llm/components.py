"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.llm.common import stored


def connected(edges: DataFrame) -> DataFrame:
    """node, component: for every node of edges (a, b), the smallest node that it is connected with.

    In each round every node that still has edges points at its smallest neighbour, if that is
    smaller than itself; pointers are followed once more; labels and edges are renamed, and edges
    inside one name vanish. A path's length shrinks by a constant factor at least, and edges that
    star around small nodes vanish in a round or two. All steps are joins and minima, which
    aggregate before they shuffle; nothing is gathered.
    """
    edges = stored(edges.select("a", "b").where("a != b").distinct())
    labels = stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("component", F.col("node")))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("name"), F.least("a", "b").alias("up"))
        parent = stored(parent)
        parent = stored(parent.join(parent.select(F.col("name").alias("up"), F.col("up").alias("upper")), "up").select("name", F.col("upper").alias("up")))
        labels = stored(labels.join(parent, labels["component"] == parent["name"], "left").select("node", F.coalesce("up", "component").alias("component")))
        renamed = edges.join(parent, edges["a"] == parent["name"]).select(F.col("up").alias("a"), "b")
        renamed = renamed.join(parent, renamed["b"] == parent["name"]).select("a", F.col("up").alias("b"))
        edges = stored(renamed.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels
