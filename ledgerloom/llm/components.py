"""Connected components of a link table by alternating star contraction, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import done, saved


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """From links (a, b) of longs: node, component (its smallest node). Links to itself, doubles and both directions may occur.

    Large star: each node sends its larger neighbours to the smallest in its neighbourhood; small star: it sends its
    smaller ones there. Minima are summed before the shuffle, so a node with very many links costs one row a task.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = saved(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc")
    mark = _mark(edges)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written, so that a join's sides come straight from shuffles and a hot node's links can be split
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = saved(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "cc")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        before, edges = edges, saved(small.distinct(), "cc")
        done(before, low, large, least)
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("links did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
