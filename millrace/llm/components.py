"""Connected components of an edge list, by Spark jobs whose number grows with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import written


def _checksum(edges: DataFrame) -> tuple:
    """Number and mixed hashes of distinct edges: the same for the same set, whatever its order."""
    h = F.xxhash64("a", "b")
    low, high = h.bitwiseAND(0xFFFFFF), F.shiftrightunsigned(h, 24).bitwiseAND(0xFFFFFF)
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(low), F.sum(high)).first())


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of the edges (a, b); nulls are not nodes.

    Each round hangs every neighbour of a node, first the larger ones and then the smaller ones, below
    the smallest node in sight, until nothing changes. Every round is a written table, so no lineage
    grows and a lost executor costs one round at most. That nothing changed is seen from a checksum. Groups are folded before the shuffle; a node with
    very many edges is one row per edge, and joins on it can be split.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _checksum(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Every larger neighbour of a node points to the node's smallest neighbour.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Every smaller neighbour, and the node, point to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        after = written(small.where("a <> b").distinct(), "small-star")
        edges, now = after, _checksum(after)
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b").distinct())
