"""Connected components by alternating large-star and small-star steps.

Each step re-points every edge at the smallest node either end has seen; after a
logarithmic number of rounds every component is a star around its smallest node.
Edges never reach the driver: only a count and a checksum do, to see whether a round
changed anything.  The minimum per node is a partially aggregated group-by, checkpointed
before the edges meet it in an equality join: with plain scans on both sides the adaptive
skew join can split a node with very many links (it could not with the aggregation between
the shuffle and the join).  Every round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _with_minimum(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the smallest v of the same u."""
    low = checkpointed(pairs.groupBy("u").agg(F.min("v").alias("m")))
    return pairs.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return (_with_minimum(both).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.least("u", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    marked = _with_minimum(down)
    return marked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
        marked.select(F.col("u").alias("a"), F.col("m").alias("b"))).where(F.col("a") != F.col("b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one orderable type);
    root is the smallest node of the component.  Self links and nulls are ignored."""
    edges = checkpointed(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now[0] == 0 or tuple(now) == before:
            break
        before = tuple(now)
        edges = checkpointed(_small_star(_large_star(edges).distinct()).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
