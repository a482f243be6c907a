"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours, and itself, to its smallest neighbour.

    The minimum is a combining aggregate and the way back a join, so a node with a third of all edges is never gathered.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    reached = both.filter("b > a") if large else both.unionAll(low.select("a", F.col("a").alias("b")))
    joined = reached.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return joined.filter("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) for every node of the edges (``a``, ``b``)."""
    edges = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        edges = stage(_star(_star(edges, large=True), large=False), "edges")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.col("a") % 1_000_003), F.sum(F.col("b") % 1_000_003)).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    own = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(own.select("node", F.col("node").alias("label"))).distinct()
