"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); root is the smallest node reachable.

    Every round is two joins on node ids; minima combine before they are
    shuffled, and a hot node's join partition is one that adaptive execution
    may split.  Each round is saved, so lineage stays short.
    """
    star = saved(edges.where("u != v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        star = saved(_small_star(_large_star(star)), "stars")
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    pairs = star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
