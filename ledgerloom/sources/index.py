"""Inverted index: which buckets of heights hold a topic of a log, or a party (sender or receiver) of a transaction.

Ingest keeps it up to date. A read joins a table to the index rows of one value, and Spark prunes the table's folders by
what that side of the join holds when the query runs. Rows may be there more than once; compact() joins them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.expr import pack, unpack
from .tables import read, scan, shared_folder

SLOTS = 64
INDEX = "value string, bucket long, chain string, kind string, slot long"
TOPIC, PARTY = "topic", "party"


def entries(logs: DataFrame | None, transactions: DataFrame | None) -> DataFrame:
    """kind, value, bucket of rows that have their block_bucket."""
    parts = []
    if logs is not None:
        parts.append(logs.select(F.lit(TOPIC).alias("kind"), F.explode("topics").alias("value"), F.col("block_bucket").alias("bucket")))
    if transactions is not None:
        parts.append(transactions.select(F.lit(PARTY).alias("kind"), F.explode(F.array_distinct(F.array("from", "to"))).alias("value"), F.col("block_bucket").alias("bucket")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    text = StringType()
    return out.where("value <> ''").withColumn("value", pack(F.col("value"), text)).distinct().withColumn("value", unpack(F.col("value"), text))


def _slot(value: Column) -> Column:
    return F.crc32(value.cast("binary")) % SLOTS


def add(rows: DataFrame, root: str, chain: str) -> None:
    """Adds (kind, value, bucket); values of a slot share a folder and are sorted in it."""
    out = rows.select("value", "bucket", F.lit(chain).alias("chain"), "kind", _slot(F.col("value")).alias("slot"))
    text = StringType()
    out = out.withColumn("value", pack(F.col("value"), text)).hint("rebalance", "kind", "slot").withColumn("value", unpack(F.col("value"), text))
    out.sortWithinPartitions("kind", "slot", "value").write.mode("append").option("compression", "zstd").partitionBy("chain", "kind", "slot").parquet(f"{root}/Index")


def buckets(spark: SparkSession, root: str, chain: str, kind: str, value: str) -> DataFrame:
    """block_bucket of each bucket that may hold rows with the value, from one folder of the index."""
    slot = zlib.crc32(value.encode()) % SLOTS
    rows = read(spark, f"{root}/Index", INDEX).where((F.col("chain") == chain) & (F.col("kind") == kind) & (F.col("slot") == slot) & (F.col("value") == value))
    return rows.select(F.col("bucket").alias("block_bucket")).distinct()


def rows(spark: SparkSession, root: str, of: str, chain: str, kind: str, value: str) -> DataFrame:
    """Rows of a table in the buckets that the index has for the value; the caller still filters by it."""
    found = scan(spark, root, of, chain, meta=True).join(buckets(spark, root, chain, kind, value), "block_bucket", "left_semi")
    return found.drop("block_bucket", "commit")


def logs_by_topic(spark: SparkSession, root: str, chain: str, topic: str) -> DataFrame:
    return rows(spark, root, "Log", chain, TOPIC, topic).where(F.array_contains("topics", topic))


def transactions_of(spark: SparkSession, root: str, chain: str, address: str) -> DataFrame:
    """Transactions sent or received by the address, exact case."""
    return rows(spark, root, "Transaction", chain, PARTY, address).where((F.col("from") == address) | (F.col("to") == address))


def build(spark: SparkSession, root: str, chain: str, of_buckets: Iterable[int] | None = None) -> None:
    """Index rows of all that is stored, or of some buckets; for tables that were filled otherwise than by ingest."""
    add(entries(scan(spark, root, "Log", chain, buckets=of_buckets, meta=True), scan(spark, root, "Transaction", chain, buckets=of_buckets, meta=True)), root, chain)


def compact(spark: SparkSession, root: str, chain: str) -> None:
    """Writes a chain's index anew without repeated rows and without buckets below the floor."""
    from .tables import BUCKET, floor

    low = floor(spark, root, chain)
    whole = read(spark, f"{root}/Index", INDEX).where(F.col("chain") == chain)
    whole = whole if low is None else whole.where(F.col("bucket") >= low // BUCKET)
    copy = shared_folder(spark, "index")
    whole.distinct().write.parquet(copy)
    out = spark.read.schema(INDEX).parquet(copy).hint("rebalance", "kind", "slot").sortWithinPartitions("kind", "slot", "value")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chain", "kind", "slot").parquet(f"{root}/Index")
