"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.workspace import discard, materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its smallest node.

    Each step links nodes to the smallest neighbour that they know of, as aggregates and joins over the
    edges; a node with very many edges is aggregated partially before the shuffle. Steps are written
    to the shared folder, so lineage stays short. The number of steps grows with the logarithm of the
    longest chain.
    """
    current = materialise(_oriented(edges), "edges")
    state = _state(current)
    while True:
        large = _star(current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = _star(large, larger=False)
        following = materialise(small, "edges")
        discard(current)
        current, last, state = following, state, _state(following)
        if state == last:
            break
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, once each."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: larger neighbours of a node go to its smallest one (both directions are given).
    Small star: a node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    if larger:
        least = least.select("a", F.least("a", "least").alias("least"))
        joined = edges.where("b > a").join(least, "a")
        return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    joined = edges.join(least, "a")
    moved = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
