"""Connected components of a link table by alternating star contraction, everything in joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.sources.workspace import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Each round hangs the larger neighbours of a node onto its smallest one, then the smaller ones; links become stars
    after a number of rounds that grows with the logarithm of the longest path. Rounds are written to the shared folder.
    Empty input gives an empty table; a link of a node to itself is a component of one.
    """
    own = links.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _mark(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    reached = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    found = reached.unionByName(roots)
    return found.unionByName(own.join(found, "node", "left_anti").distinct())


def _mark(edges: DataFrame) -> tuple:
    mark = F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(CAST(xxhash64(b, a) % 1000003 AS BIGINT))")
    return tuple(edges.agg(F.count("*"), *mark).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    above = both.where("b > a").join(lowest, "a")
    return above.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, is linked to the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    below = edges.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return below.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()
