"""Connected components of a link table by alternating large-star and
small-star rounds; each round is a Spark aggregation cut by a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``links``: (a, b) of one orderable type. Returns (node, root): every node
    of a link with the smallest node it reaches. Rounds grow with the logarithm
    of the longest path; the links of a node are only ever aggregated (minimum)
    and joined back, so a node of any degree is split like any hot join key."""
    pairs = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stage(pairs, "links")
    mark = _mark(pairs)
    while mark[0]:
        pairs = stage(_small_star(_large_star(pairs)), "links")
        new = _mark(pairs)
        if new == mark:
            break
        mark = new
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        pairs.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _mark(pairs: DataFrame) -> tuple:
    """Size and order-free hash of the links: equal when a round changed nothing."""
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node among it and its neighbours."""
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a").where("m < b")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = pairs.groupBy("b").agg(F.min("a").alias("m"))
    moved = pairs.join(least, "b")
    return (moved.select(F.col("m").alias("x"), F.col("a").alias("y"))
            .union(least.select(F.col("m").alias("x"), F.col("b").alias("y")))
            .where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
