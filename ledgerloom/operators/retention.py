"""Which blocks leave: by range, by count or by a budget of documents; plans first, then rewritten tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .ops import log_run
from ..sources.schema import DELETE_ORDER, HEIGHT
from ..sources.tables import BUCKET, file_system, raise_floor, scan


def block_range(df: DataFrame, field: str = "number") -> DataFrame:
    """lowest, highest, rows, parsed, status over a column that may be malformed: ok, no blocks or no valid blocks."""
    n = F.col(field).try_cast("long")
    out = df.agg(F.min(n).alias("lowest"), F.max(n).alias("highest"), F.count("*").alias("rows"), F.count(n).alias("parsed"))
    return out.withColumn("status", F.when(F.col("rows") == 0, "no blocks").when(F.col("parsed") == 0, "no valid blocks").otherwise("ok"))


def select_oldest(df: DataFrame, field: str, highest: int) -> DataFrame:
    """Rows at or below a height, malformed heights left out; raises if there are rows and none has a height."""
    r = block_range(df, field).first()
    if r["status"] == "no valid blocks":
        raise ValueError(f"none of {r['rows']} rows has a height in {field}")
    return df.where(F.col(field).try_cast("long") <= highest)


def by_range(blocks: DataFrame, max_blocks: int) -> DataFrame:
    """lowest, highest, span, cutoff: heights up to cutoff go, NULL if none; gaps count as heights."""
    r = blocks.agg(F.min("number").alias("lowest"), F.max("number").alias("highest")).withColumn("span", F.col("highest") - F.col("lowest") + 1)
    return r.withColumn("cutoff", F.when(F.col("span") > max_blocks, F.col("lowest") + (F.col("span") - max_blocks) - 1))


def by_count(blocks: DataFrame, keep: int) -> DataFrame:
    """number of each block that goes when the `keep` highest stay."""
    if keep <= 0:
        return blocks.select("number")
    floor = blocks.select("number").orderBy(F.desc("number")).limit(keep).agg(F.min("number").alias("floor"), F.count("*").alias("n")).first()
    return blocks.select("number").where(F.col("number") < floor["floor"] if floor["n"] == keep else F.lit(False))


def doc_counts(docs: DataFrame) -> DataFrame:
    """blockNumber, docs over (blockNumber, ...) rows of all collections."""
    return docs.groupBy("blockNumber").agg(F.count("*").alias("docs"))


def by_doc_budget(counts: DataFrame, excess: int, bucket: int = 1000) -> DataFrame:
    """blockNumber, docs, running: oldest blocks until `excess` documents are covered; all if it is never reached.

    The running sum is taken within buckets of heights and shifted by the sums of the buckets before, so only one row a
    bucket meets in one task.
    """
    rows = counts.withColumn("_b", F.expr(f"blockNumber div {bucket}"))
    sums = rows.groupBy("_b").agg(F.sum("docs").alias("_s"))
    shift = sums.select("_b", F.coalesce(F.sum("_s").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
    own = F.sum("docs").over(W.partitionBy("_b").orderBy("blockNumber").rowsBetween(W.unboundedPreceding, 0))
    out = rows.withColumn("_own", own).join(shift, "_b").select("blockNumber", "docs", (F.col("_own") + F.col("_shift")).alias("running"))
    return out.where((F.col("running") - F.col("docs") < excess) & F.lit(excess > 0))


def plan(tables: Mapping[str, DataFrame], drained: DataFrame) -> DataFrame:
    """collection, doc_id, blockNumber of all that would go with the drained heights (column number)."""
    parts = [tables[k].select(F.lit(k).alias("collection"), "doc_id", F.col(HEIGHT[k]).alias("blockNumber")) for k in DELETE_ORDER if k in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(drained.select(F.col("number").alias("blockNumber")), "blockNumber", "left_semi").select("collection", "doc_id", "blockNumber")


def apply(tables: Mapping[str, DataFrame], drained: DataFrame, write) -> list[str]:
    """Rewrites the tables without the drained heights, what depends on blocks first and blocks last.

    write(name, rows that stay) must not read what it overwrites. Errors in dependent tables are gathered and blocks are
    rewritten nevertheless; the messages are returned.
    """
    gone, errors = drained.select("number").distinct(), []
    for k in DELETE_ORDER:
        if k in tables:
            stay = tables[k].join(gone.withColumnRenamed("number", HEIGHT[k]), HEIGHT[k], "left_anti")
            try:
                write(k, stay)
            except Exception as e:  # noqa: BLE001 - reported, see above
                if k == "Block":
                    raise
                errors.append(f"{k}: {e}")
    return errors


def run(blocks: DataFrame, max_blocks: int, tracked: DataFrame | None = None) -> DataFrame:
    """number of each block that goes: by count where more than max_blocks are tracked, else by range."""
    if tracked is not None and tracked.count() > max_blocks:
        return by_count(tracked, max_blocks)
    cutoff = by_range(blocks, max_blocks).first()["cutoff"]  # a literal, so that the filter reaches the files
    return blocks.select("number").where(F.lit(False) if cutoff is None else F.col("number") <= cutoff)


def prune(spark: SparkSession, root: str, chain: str, cutoff: int | None) -> DataFrame:
    """Deletes the stored rows of a chain at heights up to cutoff; collection, rows, error of each table.

    The chain's floor is raised first, at one stroke: from then on no reader sees a row below it, wherever the run is cut
    short. Folders of buckets that lie below the floor are deleted after that, what depends on blocks first and blocks
    last; an error there is reported, blocks go nevertheless, and the next run deletes what is left. A bucket that holds
    rows on both sides of the floor stays as it is, so no row that stays is written again.
    """
    report = []
    gone = {k: scan(spark, root, k, chain, (0, cutoff)).count() for k in DELETE_ORDER} if cutoff is not None else {}
    if gone:
        low = raise_floor(spark, root, chain, cutoff + 1)
    for k in gone:
        try:
            _drop_below(spark, root, k, chain, low)
            report.append((k, gone[k], None))
        except Exception as e:  # noqa: BLE001 - reported, see above
            if k == "Block":
                raise
            report.append((k, gone[k], str(e)))
    if gone:
        _drop_below(spark, root, "Expected", chain, low)
        log_run(spark, root, "prune", low, chain, rows=sum(gone.values()), blocks=gone["Block"], docs=sum(gone.values()), last_block=cutoff)
    return spark.createDataFrame(report, "collection string, rows long, error string")


def _drop_below(spark: SparkSession, root: str, of: str, chain: str, low: int) -> None:
    folder, fs = file_system(spark, f"{root}/{of}/chain={chain}")
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        name = status.getPath().getName()
        if name.startswith("block_bucket=") and int(name.split("=")[1]) < low // BUCKET:
            fs.delete(status.getPath(), True)
