"""Connected components of a large edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it reaches.

    Every step is a grouped minimum (combined before the shuffle) joined back to
    the edges, so a node with very many edges is one small row on one side of a
    join and its edges are spread on the other.  Steps are written to the shared
    folder; their number grows with the logarithm of the longest path.  Self
    edges and repeated edges are harmless, NULL ends are ignored.
    """
    ends = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), label)
    mark = _mark(now)
    while mark[0]:
        # Large star: every larger neighbour of u meets the least of u and its neighbours.
        both = ends(now)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: u and every smaller neighbour of u meet the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        now = materialise(small, label)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionAll(
        now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))).groupBy(
        "node").agg(F.min("component").alias("component"))
