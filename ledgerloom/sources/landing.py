"""Landing files: blocks and receipts as JSON, one object a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from .schema import RAW_BLOCK, RAW_RECEIPT


def read_raw_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_BLOCK).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_raw_receipts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_RECEIPT).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def merge_receipts(batch: DataFrame, single: DataFrame) -> DataFrame:
    """Receipts fetched by block, completed by those fetched one by one; rows without a transaction hash are dropped."""
    batch, single = (d.where("transactionHash is not null") for d in (batch, single))
    return batch.unionByName(single.join(batch.select("transactionHash"), "transactionHash", "left_anti"), allowMissingColumns=True)


#: where a line stands: later files come after earlier ones, and lines of a file in order
PLACE = StructType([StructField("time", TimestampType()), StructField("path", StringType()), StructField("start", LongType()), StructField("line", LongType())])


def text_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of a folder's files as a stream, blank ones left out: value, and file, the part of a file that they are read from."""
    reader = spark.readStream.format("text")
    df = (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(folder)
    part = df.metadataColumn("_metadata")
    file = F.struct(part["file_modification_time"].alias("time"), part["file_path"].alias("path"), part["file_block_start"].alias("start"))
    return df.select("value", file.alias("file")).where(F.trim("value") != "")


def placed(df: DataFrame) -> DataFrame:
    """`file` becomes `place`."""
    return df.withColumn("place", F.struct("file.time", "file.path", "file.start", F.monotonically_increasing_id().alias("line"))).drop("file")
