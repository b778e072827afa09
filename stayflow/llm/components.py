"""Connected components of a link table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, store


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node that has
    a link (a, b).

    Alternating large-star and small-star rounds: each moves links towards the
    smallest neighbour and stops when a round changes nothing.  Links stay in
    tables of the shared folder; the driver sees only a count and a checksum.
    A node with very many links is an aggregation key (combined before the
    shuffle) and a join key (split by adaptive execution), never a group in
    one task's memory.
    """
    def star(edges: DataFrame) -> DataFrame:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Every link now points down (a > b).
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        return small.union(down.select("a", F.col("m").alias("b"))).distinct()

    def checksum(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges, path = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where(F.col("a") != F.col("b")).distinct(), "links")
    before = checksum(edges)
    while before[0]:
        done, old = edges, path
        edges, path = store(star(done), "stars")
        drop_stored(done.sparkSession, old)
        now = checksum(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
