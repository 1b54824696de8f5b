"""Freshness, run metrics and the maintenance job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.tables import read

RUN = "run long, at timestamp, rows long, rejected long, skipped long, blocks long, docs long, last_block long, seconds double"


def freshness(heads: DataFrame, as_of: Column, health_minutes: int = 10, ready_minutes: int = 5) -> DataFrame:
    """chain, last, healthy, ready by the newest successful row; a chain that never succeeded is healthy and ready."""
    out = heads.groupBy("chain").agg(F.max(F.when(F.col("success"), F.col("processed_at").cast("timestamp"))).alias("last"))
    age = F.unix_micros(as_of) - F.unix_micros("last")
    within = lambda m: F.coalesce(age <= m * 60_000_000, F.lit(True))
    return out.withColumns({"healthy": within(health_minutes), "ready": within(ready_minutes)})


def log_run(spark: SparkSession, root: str, job: str, run: int, chain: str, part: str | None = None, **counts: int | float | None) -> None:
    """Writes what one run of a job did; the same run again replaces its row."""
    row = spark.range(1).select(F.lit(run).cast("long").alias("run"), F.current_timestamp().alias("at"), *(F.lit(counts.get(f.split()[0])).cast(f.split()[1]).alias(f.split()[0]) for f in RUN.split(", ")[2:]))
    row.write.mode("overwrite").parquet(f"{root}/RunLog/chain={chain}/job={job}/part={run if part is None else part}")


def run_log(spark: SparkSession, root: str, chain: str) -> DataFrame:
    """job and what log_run() wrote, a row a run."""
    return read(spark, f"{root}/RunLog", f"{RUN}, chain string, job string, part string").where(F.col("chain") == chain).drop("chain", "part")


def metrics(run_log: DataFrame) -> DataFrame:
    """job, blocks, docs, last_block, last_run, runs over (job, blocks, docs, last_block, at)."""
    return run_log.groupBy("job").agg(F.sum("blocks").alias("blocks"), F.sum("docs").alias("docs"), F.max("last_block").alias("last_block"), F.max("at").alias("last_run"), F.count("*").alias("runs"))


class RunListener(StreamingQueryListener):
    """Writes a row of the run log for each batch of the streaming queries that have a name, as they report it."""

    def __init__(self, spark: SparkSession, root: str, chain: str):
        self.spark, self.root, self.chain = spark, root, chain

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name and p.numInputRows:
            log_run(self.spark, self.root, f"query-{p.name}", p.batchId, self.chain, rows=p.numInputRows, seconds=p.batchDuration / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def maintain(export: Callable[[], None], retain: Callable[[], None]) -> None:
    """Exports, then deletes; nothing is deleted if the export fails."""
    export()
    retain()
