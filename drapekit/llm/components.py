"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free sum of hashes: equal marks mean an unchanged edge set."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node that can be
    reached.  Each round hangs the neighbours of a node under its smallest neighbour (first
    the larger ones, then the smaller ones), so chains shrink geometrically; edges never
    outnumber the links, and a node with many neighbours is reduced by a map-side minimum."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = written(small.where("a <> b").distinct(), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
