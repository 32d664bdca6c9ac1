"""Distributed connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, packed


def _large_star(e: DataFrame, n: int) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour;
    ``n`` is the number of edges, here and in the other step."""
    both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    moved = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return packed(moved, n)


def _small_star(e: DataFrame, n: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return packed(packed(moved.unionAll(low.select("u", F.col("m").alias("v"))).filter("u != v"), n).distinct(), n)


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Smallest node reachable from each node that has an edge.

    Returns (node, component).  Null ends, loops and repeated edges have no
    effect.  A node with many edges is never one group: each step is a
    pre-aggregated minimum joined back to the edges, which adaptive execution
    splits.  Every round is written to the checkpoint folder; the number of
    rounds grows with the logarithm of the longest chain.
    """
    a, b = F.col(src), F.col(dst)
    e = cut(
        edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first()
        if tuple(now) == mark or now[0] == 0:
            break
        mark, n = tuple(now), now[0]
        # Few edges are moved by few tasks, as each writes files of its own.
        e = cut(_small_star(_large_star(packed(e, n), n), n))
    # Every edge now leads from a node to its component's smallest node.
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
