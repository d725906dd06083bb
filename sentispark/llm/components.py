"""Connected components by alternating large-star and small-star rounds.

Each round is an aggregation and a join over the edge table; no component or
neighbourhood is ever gathered in one place.  Edges are written to the shared
folder after each round, so a lost executor costs one round at most; the round before goes then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``(a, b)`` with b < a.  Large star: link every larger neighbour of a node to the
    node's smallest neighbour (or itself); small star: link the smaller neighbours and
    the node."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = (edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionAll(least.select("a", F.col("m").alias("b"))))
    return out.where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of ``pairs`` (``a, b``)."""
    edges = written(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        before, edges = edges, written(_star(_star(edges, True), False), "edges")
        discard(before)
        # all edges of a star forest point at roots, and the next round leaves them as they are
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
