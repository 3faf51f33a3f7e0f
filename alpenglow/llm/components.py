"""Connected components of a graph given by its edges, with as many rows in each step as there are edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpenglow.llm.common import written


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for every node on an edge. edges: a, b (long), in any direction.

    Alternates linking each node's larger neighbours, then its smaller ones, to its smallest neighbour, until nothing
    changes (each step halves the depth of the trees, about). Each step is written, so a lost executor costs one step. A
    node's neighbours are only ever aggregated and joined, never gathered.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a star's own centre loses its larger neighbours to the smallest node, and keeps its link to it
        large = large.unionByName(least.filter("m < a").select("a", F.col("m").alias("b")))
        large = written(large.filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select("b", "m")
        small = small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        new = _state(edges)
        if new == state:
            return edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = new


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and two sums of hashes (three numbers reach the driver)."""
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("bigint"))).first())
