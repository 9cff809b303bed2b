"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    # Staged, so that the joining stage computes nothing else and Spark can split a hub's edges.
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    least = stage(least, "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.hex("a")))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """For every node of edges (a, b) the smallest node it is connected to: node, root.

    Loops, repeated edges and either direction are allowed. A hub's edges are never gathered: the
    least neighbour is a combining aggregate, and the join back splits a skewed node. Every round is
    a table in the shared folder; the number of rounds grows with the logarithm of the nodes.
    """
    current = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = _mark(current)
    while True:
        current = stage(_small_star(_large_star(current)).where("a <> b").distinct(), "edges")
        previous, mark = mark, _mark(current)
        if mark == previous:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
