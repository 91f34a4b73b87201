"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its least node) of every node of edges (a, b); each round is written to the shared folder;
    raises where max_rounds end before two rounds agree.

    A large-star step links every greater neighbour of a node to its least neighbour, a small-star step every smaller one;
    rows never exceed the edges, and the number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialize(edges, "component-edges")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges, last = materialize(small.where("a <> b").distinct(), "component-edges"), edges
        discard(last)
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    least = edges.groupBy("a").agg(F.min("b").alias("b"))
    nodes = least.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(least.select("b", "b").distinct().toDF("node", "component"))
