"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a long, b long)``.

    ``root`` is one node of the component, the same for all its nodes. Nodes
    without an edge to another node are absent.

    Randomised contraction: in each round a node joins the member of its
    closed neighbourhood with the smallest hash, and the edges are rewritten
    between the chosen nodes. Only minima and equi-joins are used: a minimum
    is combined before the shuffle, so a node with very many neighbours costs
    a task no more than any other, and joins on such a node are split by
    adaptive execution. Every round leaves a constant share of the nodes, so
    rounds grow with the logarithm of the largest component.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stored(edges.filter(F.col("a") != F.col("b")).select(*pair).distinct(), "edges")
    labels = None
    turn = 0
    while not edges.isEmpty():
        ordered = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("node"))
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min(ordered("b")).alias("n"))
        chosen = stored(
            nearest.select(F.col("a").alias("node"), F.least("n", ordered("a"))["node"].alias("rep")), "reps"
        )
        left = chosen.select(F.col("node").alias("a"), F.col("rep").alias("ra"))
        right = chosen.select(F.col("node").alias("b"), F.col("rep").alias("rb"))
        moved = edges.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        edges = stored(moved.filter(F.col("a") != F.col("b")).select(*pair).distinct(), "edges")
        if labels is None:
            labels = chosen.select("node", F.col("rep").alias("root"))
        else:
            step = chosen.select(F.col("node").alias("root"), "rep")
            labels = labels.join(step, "root", "left").select("node", F.coalesce("rep", "root").alias("root"))
        turn += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stored(labels, "labels")
