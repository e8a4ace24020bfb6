"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import stored


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (a, b) with a > b.

    Large: every larger neighbour of a node is linked to the node's smallest neighbour, itself
    included. Small: so are the node itself and its smaller neighbours.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        new = both.filter("b > a").join(least, F.col("a") == F.col("node")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        new = edges.join(least, F.col("a") == F.col("node"))
        new = new.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return new.distinct()


def summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    `edges` has columns a and b; direction, repeats and loops do not matter. Large stars are split
    over tasks by the join; every step is written to the shared folder.
    """
    now = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    known = summary(now)
    while known[0]:
        now = stored(star(star(now, True), False), "edges")
        after = summary(now)
        if after == known:
            break
        known = after
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(now.select(
        F.col("b").alias("node"), F.col("b").alias("component")).distinct())
