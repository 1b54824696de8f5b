"""Landing files to staged Parquet, each line once, and to dead letters what cannot be used.

A line is parsed once. Staged rows keep the raw fields, their height and their place (file by file, line by line), by buckets
of heights; a line that breaks a rule goes to the table Reject with its code, file and raw text. A replayed batch writes its
own folder again, so each line is staged or rejected exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions import expr as X
from ..operators import ops, quality
from ..sources.landing import PLACE, placed, text_lines
from ..sources.schema import RAW_BLOCK, RAW_RECEIPT
from ..sources.tables import BUCKET, read

#: bucket of rows without a height, and of rejected lines
NOWHERE, BAD = -1, -2
CORRUPT = "_corrupt_record"
REJECT = "code string, severity string, retry string, component string, operation string, block string, tx string, file string, raw string, source string, stage long, chain string"


@dataclass
class Kind:
    """What a landing folder holds: the schema of a line, the field with its height, and rules by code."""

    name: str
    schema: StructType
    height: str
    rules: Callable[[], Mapping[str, Column]]
    tx: str


def _block_rules() -> dict[str, Column]:
    return {"PARSING_FAILED": F.col(CORRUPT).isNotNull(), "INVALID_BLOCK_FORMAT": (X.blank(F.col("hash")) == "") | F.col("number").isNull(), "INVALID_HEX": X.to_int(F.col("number")).isNull()}


def _receipt_rules() -> dict[str, Column]:
    return {"PARSING_FAILED": F.col(CORRUPT).isNotNull(), "INVALID_INPUT_FORMAT": X.blank(F.col("transactionHash")) == "", "INVALID_HEX": F.col("blockNumber").isNotNull() & X.to_int(F.col("blockNumber")).isNull()}


BLOCKS = Kind("blocks", RAW_BLOCK, "number", _block_rules, "null")
RECEIPTS = Kind("receipts", RAW_RECEIPT, "blockNumber", _receipt_rules, "transactionHash")


def staged_schema(kind: Kind) -> StructType:
    fields = [f for f in kind.schema.fields if f.name != CORRUPT]
    return StructType([*fields, StructField("height", LongType()), StructField("place", PLACE), StructField("staged_at", TimestampType()), StructField("preferred", LongType()), StructField("stage", LongType()), StructField("block_bucket", LongType())])


@dataclass
class Staging:
    """Folders of one ingest: staged rows below `path`, rejects in the tables' root; runs are logged there too."""

    spark: SparkSession
    path: str
    root: str
    chain: str

    def stage(self, kind: Kind, folder: str, preferred: int = 1, files_per_trigger: int | None = None, trigger: dict | None = None) -> StreamingQuery:
        """Stages the files of a folder that came since the last call, or goes on doing so by the trigger.

        preferred: 1 for receipts fetched by block, 0 for those fetched one by one, which count where the former are missing.
        """
        name = f"{kind.name}-{preferred}"

        def put(lines: DataFrame, number: int) -> None:
            self._put(kind, lines, number, preferred)

        out = text_lines(self.spark, folder, files_per_trigger).writeStream.foreachBatch(put).option("checkpointLocation", f"{self.path}/checkpoint-{name}")
        return out.trigger(**(trigger or {"availableNow": True})).start()

    def _put(self, kind: Kind, lines: DataFrame, number: int, preferred: int) -> None:
        parsed = placed(lines).withColumn("_r", F.from_json("value", kind.schema, {"columnNameOfCorruptRecord": CORRUPT}))
        rows = parsed.select("_r.*", "value", "place")
        code = F.coalesce(*(F.when(c, F.lit(k)) for k, c in kind.rules().items()))
        rows = rows.withColumn("code", code).withColumn("height", F.when(F.col("code").isNull(), X.to_int(F.col(kind.height))))
        bucket = F.when(F.col("code").isNotNull(), F.lit(BAD)).otherwise(F.coalesce(F.expr(f"height div {BUCKET}"), F.lit(NOWHERE)))
        rows = rows.withColumn("value", F.when(F.col("code").isNotNull(), F.col("value"))).withColumn("staged_at", F.current_timestamp()).withColumn("block_bucket", bucket.cast("long")).drop(CORRUPT)
        seen = Observation()
        rows = rows.observe(seen, F.count("*").alias("rows"), F.count("code").alias("rejected"), F.max("height").alias("last_block"))
        folder = f"{self.path}/{kind.name}/preferred={preferred}/stage={number}"
        # lines of a landing file stay together, as its heights are near each other: nothing moves
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("block_bucket").parquet(folder)
        n = seen.get
        source = f"{kind.name}-{preferred}"
        if n["rejected"]:
            bad = self.spark.read.schema(StructType([*rows.drop("block_bucket").schema.fields])).parquet(f"{folder}/block_bucket={BAD}")
            always = {k: F.col("code") == k for k in kind.rules()}
            _, out = quality.split(bad, always, "ingest", kind.name, F.col(kind.height), F.expr(kind.tx), file=F.col("place.path"), raw=F.col("value"))
            out.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/Reject/chain={self.chain}/source={source}/stage={number}")
        ops.log_run(self.spark, self.root, f"stage-{source}", number, self.chain, rows=n["rows"], rejected=n["rejected"], last_block=n["last_block"])

    def rows(self, kind: Kind, buckets: list[int]) -> DataFrame:
        """Staged rows of the given buckets."""
        return read(self.spark, f"{self.path}/{kind.name}", staged_schema(kind)).where(F.col("block_bucket").isin(buckets))

    def stream(self, kind: Kind) -> DataFrame:
        """Staged rows as they come."""
        files = self.spark.readStream.schema(staged_schema(kind)).option("ignoreMissingFiles", "true")
        return files.parquet(f"{self.path}/{kind.name}").where(F.col("block_bucket") != BAD)


def rejects(spark: SparkSession, root: str, chain: str) -> DataFrame:
    """Lines of a chain's landing files that were rejected."""
    return read(spark, f"{root}/Reject", REJECT).where(F.col("chain") == chain).drop("chain")
