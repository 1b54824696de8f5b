"""Chain tables as Parquet, partitioned by chain and by a bucket of heights.

Rows of a bucket are dealt and sorted by the hash that they are looked up by, so that files and row groups hold ranges of
it, and carry Bloom filters for it. Each row has the commit that wrote it, which no later rewriting changes. A chain's
floor is the lowest height that counts: rows below it are gone for every reader from the moment the floor is raised.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import content_doc_id, content_id, pack, unpack
from .schema import HEIGHT, IDS, KEYS, META, TABLES, StructType, ensure

BUCKET = 1000
#: the column that rows of a bucket are dealt and sorted by, and those that have Bloom filters
CLUSTER = {"Block": "hash", "Transaction": "hash", "Log": "transactionHash", "AccessListEntry": "transaction_id", "BlockSignature": "blockHash"}
BLOOM = {"Block": ("hash",), "Transaction": ("hash",), "Log": ("transactionHash", "blockHash"), "AccessListEntry": ("transaction_id",), "BlockSignature": ("blockHash",)}


def with_ids(df: DataFrame, *content: str) -> DataFrame:
    """doc_id and cid from the row's own content: all columns, or those named."""
    names = [c for c in df.columns if c not in ("doc_id", "cid")]
    out = df.select(*names).withColumn("cid", content_id(*(content or names)))
    return out.select(content_doc_id(F.col("cid")).alias("doc_id"), "cid", *names)


def bucket_of(height: str) -> Column:
    return F.expr(f"`{height}` div {BUCKET}").cast("long")


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A folder of Parquet files, empty where it does not exist yet."""
    where, fs = file_system(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(where) else spark.createDataFrame([], schema)


def stored_schema(of: str) -> StructType:
    return StructType([*IDS.fields, *TABLES[of].fields, *META.fields]).add("chain", "string").add("block_bucket", "long")


def scan(spark: SparkSession, root: str, of: str, chain: str, heights: tuple[int, int] | None = None, buckets: Iterable[int] | None = None, meta: bool = False) -> DataFrame:
    """Rows of one chain from its floor on; a range of heights or a list of buckets prunes folders and reaches the Parquet filters.

    meta: with `commit` and `block_bucket`.
    """
    df = read(spark, f"{root}/{of}", stored_schema(of)).where(F.col("chain") == chain)
    if of in HEIGHT:
        low = floor(spark, root, chain)
        if heights:
            df = df.where(F.col("block_bucket").between(heights[0] // BUCKET, heights[1] // BUCKET) & F.col(HEIGHT[of]).between(*heights))
        if buckets is not None:
            df = df.where(F.col("block_bucket").isin(list(buckets)))
        if low is not None:
            df = df.where((F.col("block_bucket") >= low // BUCKET) & (F.col(HEIGHT[of]) >= low))
    return df.drop("chain") if meta else df.drop("chain", "block_bucket", *META.fieldNames())


def clustered(df: DataFrame, of: str) -> DataFrame:
    """Rows by bucket and, where a bucket has more than a file's worth, by the first digits of its hash; sorted within.

    How many files there are follows from the size of the data, as AQE joins small shuffle partitions and splits large ones.
    """
    if of not in CLUSTER:
        return df
    lot = F.substring(F.col(CLUSTER[of]), 1, 4)  # 0x and two digits
    kinds = df.schema
    dealt = df.select(*(pack(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in kinds), lot.alias("_lot")).hint("rebalance", "block_bucket", "_lot")
    return dealt.select(*(unpack(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in kinds)).sortWithinPartitions("block_bucket", CLUSTER[of])


def write(df: DataFrame, root: str, of: str, mode: str = "append", stay: bool = False) -> None:
    """Writes rows that have chain, block_bucket and commit; those without ids get them when they have moved to their files.

    stay: rows are sorted where they lie and do not move; each task then writes a file for each of its buckets.
    """
    rows = df.sortWithinPartitions("block_bucket", CLUSTER[of]) if stay and of in CLUSTER else clustered(df, of)
    out = (rows if "doc_id" in df.columns else with_ids(rows, *TABLES[of].fieldNames())).write.mode(mode).option("compression", "zstd").partitionBy("chain", "block_bucket")
    for c in BLOOM.get(of, ()):
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", str(1 << 20))
    out.parquet(f"{root}/{of}")


def append_new(
    df: DataFrame, root: str, of: str, chain: str, mode: str = "append", heights: tuple[int, int] | None = None, buckets: Iterable[int] | None = None, unique: bool = False, fresh: bool = False, stay: bool = False,
) -> DataFrame:
    """Appends rows whose key the table lacks, the first of equal keys in the batch; returns what was new.

    heights, buckets: what holds all rows of df; keys are then read from there only. unique: no key is there twice in df, so
    its rows need not meet; fresh: none is in the table. Rows meet by their keys only where 64 bits of these do. Rows without ids get them when they
    are known to be new, so that ids do not travel to their keys. stay: as for write().
    """
    spark, keys = df.sparkSession, KEYS[of]
    ensure(spark, root, of)
    have = scan(spark, root, of, chain, heights, buckets).select(*keys)
    bare = "doc_id" not in df.columns
    names = [*(() if bare else IDS.fieldNames()), *TABLES[of].fieldNames()]
    rows = df.select(*names)
    keyed = with_ids(rows) if bare and "doc_id" in keys else rows
    if not unique and repeated(keyed, keys):
        rows = keyed = keyed.dropDuplicates(keys)
    if not fresh and meet(keyed, have, keys):
        rows = keyed.join(have, keys, "left_anti").select(*keyed.columns)
    bucket = bucket_of(HEIGHT[of]) if of in HEIGHT else F.lit(0).cast("long")
    write(rows.withColumns({"commit": F.unix_micros(F.current_timestamp()), "chain": F.lit(chain), "block_bucket": bucket}), root, of, mode, stay)
    return rows if "doc_id" in rows.columns else with_ids(rows)


def repeated(rows: DataFrame, keys: list[str]) -> bool:
    """Whether a key may be there twice: as 64 bits, so that rows need not move to see that none is."""
    return bool(rows.groupBy(F.xxhash64(*keys).alias("_k")).count().where("count > 1").head(1))


def meet(rows: DataFrame, have: DataFrame, keys: list[str]) -> bool:
    """Whether a key of rows may be among those of have, as 64 bits."""
    theirs = have.select(F.xxhash64(*keys).alias("_k"))
    return bool(theirs.head(1)) and bool(theirs.join(rows.select(F.xxhash64(*keys).alias("_k")), "_k", "left_semi").head(1))


def add(spark: SparkSession, root: str, of: str, chain: str, rows: list[dict]) -> DataFrame:
    """Adds rows given by value, relation ids included; returns them with their ids."""
    df = with_ids(spark.createDataFrame([{f.name: r.get(f.name) for f in TABLES[of].fields} for r in rows], TABLES[of]))
    append_new(df, root, of, chain)
    return df


# --- the floor of a chain ---


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def floor(spark: SparkSession, root: str, chain: str) -> int | None:
    """Lowest height of a chain that counts, None where all do."""
    where, fs = file_system(spark, f"{root}/_floor/chain={chain}")
    if not fs.exists(where):
        return None
    return max((int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit()), default=None)


def raise_floor(spark: SparkSession, root: str, chain: str, height: int) -> int:
    """Raises the floor, never lowers it; returns it. An empty file named by the height comes into being by one rename,
    so readers see the old floor or the new one."""
    have = floor(spark, root, chain)
    if have is not None and have >= height:
        return have
    part, fs = file_system(spark, f"{root}/_floor/_part-{uuid.uuid4().hex}")
    whole, _ = file_system(spark, f"{root}/_floor/chain={chain}/{height}")
    fs.create(part, True).close()
    fs.mkdirs(whole.getParent())
    fs.rename(part, whole)
    for s in fs.listStatus(whole.getParent()):
        if s.getPath().getName().isdigit() and int(s.getPath().getName()) < height:
            fs.delete(s.getPath(), False)
    return height


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which all executors share; a local folder stands in on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
