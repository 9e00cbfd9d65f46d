"""Connected components of an edge table by contraction; nothing is gathered at the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b), two longs: component is the smallest node that can be reached.

    Each round points a node at its smallest neighbour (or itself), follows pointers twice, and replaces the ends of every edge by what they point at; edges
    that became loops are gone. The smallest node of a component always points at itself, so when no edge is left all nodes point at it. A row
    with a null end is no edge. No edges give no rows.
    """
    edges = cut(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        to = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("to")), "pointers")
        for _ in range(2):
            to = _follow(to, to, "to")
        to = cut(to, "pointers")
        labels = to.withColumnRenamed("to", "component") if labels is None else cut(_follow(labels, to, "component"), "labels")
        edges = cut(_follow(_follow(edges, to, "a"), to, "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels


def _follow(rows: DataFrame, to: DataFrame, column: str) -> DataFrame:
    """rows with `column` replaced by what it points at, if it points."""
    ahead = to.select(F.col("node").alias("__node"), F.col("to").alias("__to"))
    return rows.join(ahead, F.col(column) == F.col("__node"), "left").withColumn(column, F.coalesce("__to", column)).drop("__node", "__to")


def extended(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (node, component) after further edges."""
    to = labels.select("node", F.col("component").alias("to"))
    more = components(_follow(_follow(edges.select("a", "b"), to, "a"), to, "b"))
    to = more.select("node", F.col("component").alias("to"))
    fresh = more.join(labels.select("node"), "node", "left_anti")
    return cut(_follow(labels, to, "component").unionByName(fresh), "labels")
