"""Subscriptions, in-order release and what is read off the heights."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.schema import HEIGHT, META, ensure
from ..sources.tables import file_system, floor, stored_schema
from .staging import REJECT
from .ingest import ROCKS, ingest  # noqa: F401 - ingest is part of this module's interface


def subscribe(spark: SparkSession, root: str, of: str, chain: str, condition: Column | None = None, horizon: str = "1 hour", files_per_trigger: int | None = None) -> DataFrame:
    """Rows of a chain's table as a stream from its beginning on, each once however often its files are written again.

    A row is known by its doc_id and its commit, which rewriting keeps. One that comes again within the horizon of the
    newest commit seen meets the state, which forgets it after that; later than that it is too old to be taken. The
    result has the table's columns and `committed_at`. Rows below the floor that stands when the stream begins are left out.
    """
    ensure(spark, root, of)
    files = spark.readStream.schema(stored_schema(of)).option("ignoreMissingFiles", "true")
    rows = (files.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else files).parquet(f"{root}/{of}").where(F.col("chain") == chain)
    low = floor(spark, root, chain)
    rows = rows.where(F.col(HEIGHT[of]) >= low) if low is not None and of in HEIGHT else rows
    rows = rows.withColumn("committed_at", F.timestamp_micros("commit")).withWatermark("committed_at", horizon)
    rows = rows.where(condition) if condition is not None else rows
    return rows.dropDuplicates(["doc_id", "commit", "committed_at"]).drop("chain", "block_bucket", *META.fieldNames())


def subscribe_rejects(spark: SparkSession, root: str, chain: str) -> DataFrame:
    """Rejected lines of a chain as a stream."""
    where, fs = file_system(spark, f"{root}/Reject")
    fs.mkdirs(where)
    return spark.readStream.schema(REJECT).option("ignoreMissingFiles", "true").parquet(f"{root}/Reject").where(F.col("chain") == chain).drop("chain")


# --- release in order ---

#: heights whose results wait together
SPAN = 1000


class Gather(StatefulProcessor):
    """Results of SPAN heights of a chain: gives out the run of heights from the first on that has come."""

    def __init__(self, start: int):
        self.start = start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("results", "next int, seen binary, ok binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chain, span = key[0], int(key[1])
        base = span * SPAN
        if self.state.exists():
            at, seen, ok = self.state.get()
            seen, ok = (np.unpackbits(np.frombuffer(x, np.uint8), count=SPAN) for x in (seen, ok))
        else:
            at, seen, ok = max(0, self.start - base), np.zeros(SPAN, np.uint8), np.zeros(SPAN, np.uint8)
        for f in rows:
            i = f["number"].to_numpy(np.int64) - base
            seen[i], ok[i] = 1, f["ok"].to_numpy(bool)
        stop = at + int(np.argmin(np.append(seen[at:], 0)))
        self.state.update((stop, np.packbits(seen).tobytes(), np.packbits(ok).tobytes()))
        if stop > at:
            yield pd.DataFrame({"chain": [chain], "span": [span], "first": [base + at], "oks": [ok[at:stop].tobytes()]})

    def close(self) -> None:
        pass


class Release(StatefulProcessor):
    """Runs of heights of a chain: gives them out in order; those that wait stand by span, so a batch writes only its own."""

    def __init__(self, start: int):
        self.start = start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.frontier = handle.getValueState("frontier", "height long")
        self.waiting = handle.getMapState("waiting", "span long", "first long, oks binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for f in rows:
            for r in f.itertuples():
                k = (int(r.span),)
                if self.waiting.containsKey(k):
                    first, oks = self.waiting.getValue(k)
                    self.waiting.updateValue(k, (first, bytes(oks) + bytes(r.oks)))
                else:
                    self.waiting.updateValue(k, (int(r.first), bytes(r.oks)))
        at = self.frontier.get()[0] if self.frontier.exists() else self.start
        out = []
        while self.waiting.containsKey((at // SPAN,)):
            first, oks = self.waiting.getValue((at // SPAN,))
            self.waiting.removeKey((at // SPAN,))
            out.append((key[0], first, bytes(oks)))
            at = first + len(oks)
        self.frontier.update((at,))
        yield pd.DataFrame(out, columns=["chain", "first", "oks"])

    def close(self) -> None:
        pass


def in_order(results: DataFrame, start: int, window: int = 16) -> DataFrame:
    """Stream of (chain, number, ok) released in height order a chain: chain, number, ok.

    A height waits until all below it from `start` on have come, failed ones too. Results wait as bits in the state of
    their span of 1000 heights, on disk and spread over tasks; a chain's own state has a frontier and the complete runs of
    spans that lie beyond it. window: of old the number of waiting heights that ended a query; there is no limit now.
    """
    spark = results.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    keyed = results.where(F.col("number") >= start).withColumn("span", F.expr(f"number div {SPAN}"))
    runs = keyed.groupBy("chain", "span").transformWithStateInPandas(Gather(start), "chain string, span long, first long, oks binary", "Append", "None")
    freed = runs.groupBy("chain").transformWithStateInPandas(Release(start), "chain string, first long, oks binary", "Append", "None")
    marks = F.sequence(F.lit(1), F.octet_length("oks"))
    return freed.select("chain", "first", F.explode(marks).alias("i"), "oks").select("chain", (F.col("first") + F.col("i") - 1).alias("number"), (F.hex(F.expr("substring(oks, i, 1)")) == "01").alias("ok"))


def plan_start(stored: DataFrame, tip: int, configured: int = 0, buffer: int = 100) -> DataFrame:
    """start: after the highest stored height, or `buffer` below the tip if that is further on; else as configured."""
    hi = F.col("hi")
    near = F.lit(max(tip - buffer, 0)).cast("long")
    fresh = F.lit(configured).cast("long") if configured > 0 else near
    return stored.agg(F.max("number").alias("hi")).select(F.when(hi.isNull(), fresh).when(F.lit(tip) - hi > buffer, near).otherwise(hi + 1).alias("start"))


def gaps(blocks: DataFrame, bucket: int = 100_000) -> DataFrame:
    """first_missing, last_missing for each hole; holes between buckets of heights come from the buckets' ends."""
    rows = blocks.select("number").distinct().withColumn("b", F.expr(f"number div {bucket}"))
    inside = rows.withColumn("next", F.lead("number").over(W.partitionBy("b").orderBy("number")))
    ends = rows.groupBy("b").agg(F.min("number").alias("low"), F.max("number").alias("number"))
    across = ends.withColumn("next", F.lead("low").over(W.orderBy("b"))).select("number", "next")
    holes = inside.select("number", "next").unionByName(across).where("next - number > 1")
    return holes.select((F.col("number") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing"))


def confirmed(blocks: DataFrame, depth: int = 100, readable: Column | None = None, tries: int = 8) -> DataFrame:
    """Blocks at least `depth` below the highest one.

    readable: whether a block can be taken. The target is then the block `depth` below the highest, or where that cannot
    be read the one at twice the depth, four times, and so on, for `tries` in all; none of them leaves no blocks.
    """
    tip = blocks.agg(F.max("number")).first()[0]  # a literal, so that the filter reaches the files
    if tip is None:
        return blocks.where(F.lit(False))
    if readable is None:
        return blocks.where(F.col("number") <= tip - depth)
    targets = [tip - depth * 2**k for k in range(tries)]
    target = blocks.where(F.col("number").isin(targets) & readable).agg(F.max("number")).first()[0]
    return blocks.where(F.lit(False) if target is None else F.col("number") <= target)
