"""Which heights a chain has, as intervals by bucket, kept up to date by adding batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.tables import BUCKET, floor, read

RUNS = "array<struct<low: bigint, high: bigint>>"
HEIGHTS = f"block_bucket long, runs {RUNS}, commit long, chain string, part string"


def merged(runs: DataFrame) -> DataFrame:
    """block_bucket, runs from rows (block_bucket, low, high) in any order, overlapping or not: the fewest intervals that cover them."""
    own = W.partitionBy("block_bucket").orderBy("low", "high")
    before = F.max("high").over(own.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("low") <= F.col("_before") + 1, 0).otherwise(1)).over(own.rowsBetween(W.unboundedPreceding, 0))
    rows = runs.withColumn("_before", before).withColumn("_island", island)
    out = rows.groupBy("block_bucket", "_island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return out.groupBy("block_bucket").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("runs"))


def current(spark: SparkSession, root: str, chain: str, buckets: list[int] | None = None) -> DataFrame:
    """block_bucket, runs: the last row of each bucket."""
    rows = read(spark, f"{root}/Heights", HEIGHTS).where(F.col("chain") == chain)
    rows = rows if buckets is None else rows.where(F.col("block_bucket").isin(buckets))
    return rows.groupBy("block_bucket").agg(F.max_by("runs", "commit").alias("runs"))


def add(heights: DataFrame, root: str, chain: str, part: str) -> None:
    """Adds heights (number); reads and writes the rows of their own buckets only. The same part again replaces itself."""
    spark = heights.sparkSession
    new = heights.select(F.expr(f"number div {BUCKET}").alias("block_bucket"), F.col("number").alias("low"), F.col("number").alias("high"))
    buckets = [r[0] for r in new.select("block_bucket").distinct().collect()]  # one for each 1000 heights of the batch
    old = current(spark, root, chain, buckets).select("block_bucket", F.explode("runs").alias("r")).select("block_bucket", "r.low", "r.high")
    out = merged(new.unionByName(old)).withColumn("commit", F.unix_micros(F.current_timestamp()))
    # written elsewhere would be read while it is replaced: a part reads only others, as it is the newest
    out.coalesce(1 + len(buckets) // 10_000).write.mode("overwrite").parquet(f"{root}/Heights/chain={chain}/part={part}")


def gaps(spark: SparkSession, root: str, chain: str) -> DataFrame:
    """first_missing, last_missing of each hole from the lowest to the highest height, or from the floor on; a row a bucket is read."""
    rows = current(spark, root, chain)
    if (low := floor(spark, root, chain)) is not None:
        keep = F.filter("runs", lambda r: r["high"] >= low)
        rows = rows.withColumn("runs", F.transform(keep, lambda r: F.struct(F.greatest(r["low"], F.lit(low).cast("long")).alias("low"), r["high"].alias("high")))).where("size(runs) > 0")
    holes = lambda ends: F.transform(F.sequence(F.lit(1), F.size("runs") - 1), lambda i: F.struct((F.get("runs", i - 1)["high"] + 1).alias("first_missing"), (F.get("runs", i)["low"] - 1).alias("last_missing")))
    inside = rows.where("size(runs) > 1").select(F.explode(holes("runs")).alias("h")).select("h.*")
    ends = rows.select("block_bucket", F.get("runs", F.lit(0))["low"].alias("low"), F.element_at("runs", -1)["high"].alias("high"))
    across = ends.withColumn("next", F.lead("low").over(W.orderBy("block_bucket"))).where("next - high > 1")
    return inside.unionByName(across.select((F.col("high") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing")))
