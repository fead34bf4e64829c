"""Connected components of a graph of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.session import durable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``a, b`` for links a-b of long ids: ``node, root``, one row a linked node but the roots
    themselves, where the root is the smallest node of the component.

    Each round points every node at the smallest one it can see, first for its larger and then for
    its smaller neighbours; the number of rounds goes with the logarithm of the longest path. A
    node's neighbours are never gathered: the smallest is a partial sum, and the join that follows
    has one row a node on its other side, so a hub is split over tasks. Each round is written to
    the shared folder."""
    hi, lo = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = durable(links.where("a <> b").select(hi, lo).dropDuplicates(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(large.dropDuplicates(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = durable(small.unionByName(least.select("a", F.col("m").alias("b"))).dropDuplicates(), "links")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
