"""Connected components of a graph given as a table of edges, by Spark rounds with written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node of its component.

    Every round links each node with the smallest neighbour of both of its ends and lets it jump to
    its root's root; the edges shrink to those between different roots.  Sums of a node's edges are
    taken in the tasks first, so a node with very many edges costs no more than another.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    labels = None
    while not edges.isEmpty():
        # Each root hooks onto its smallest neighbour if that is smaller; b > a, so hooks make no cycles.
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        if labels is None:
            labels = nodes.join(hooks, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        else:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            labels = labels.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
        labels = written(_jumped(labels), "labels")
        ends = labels.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        moved = edges.join(ends, "a").select("_a", "b").join(ends.select(F.col("a").alias("b"), F.col("_a").alias("_b")), "b")
        moved = moved.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        # Roots are their own labels, so their edges can be looked up in the same table.
        edges = written(moved.distinct(), "edges")
    return nodes.select("node", F.col("node").alias("root")) if labels is None else labels


def _jumped(labels: DataFrame) -> DataFrame:
    """Let every node point at its chain's end."""
    while True:
        labels = written(labels, "hooks")
        ends = labels.filter("node <> root").select(F.col("node").alias("root"), F.col("root").alias("_next"))
        chained = labels.join(ends, "root", "left_semi").limit(1)
        if chained.isEmpty():
            return labels
        labels = labels.join(ends, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
