"""The chain view as landing files, taken in by the stream: what the tables then hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

from ..functions import expr as X
from ..operators import retention, snapshot
from ..sources.tables import append_new, file_system, scan, shared_folder, write
from ..streaming import stream
from .chainview import ChainView

CHAIN = "Ethereum__Mainnet"
_ROOTS: dict[tuple[str, str], str] = {}
#: receipts of a landing file, which one task reads
LINES = 50_000


def raw_blocks(v: ChainView) -> DataFrame:
    """Blocks as a node gives them: numbers in hex, transactions in order with their access lists."""
    blocks, text = v.blocks(), StringType()
    hexed = ("hash", "parentHash", "miner")
    rows = blocks.withColumns({c: X.pack(F.col(c), text) for c in hexed}).join(v.nested(), F.col("number") == F.col("blockNumber"), "left").withColumns({c: X.unpack(F.col(c), text) for c in hexed})
    return rows.select(X.to_hex(F.col("number")).alias("number"), "hash", "parentHash", "timestamp", "miner", "gasUsed", "gasLimit", "transactions")


def raw_receipts(v: ChainView) -> DataFrame:
    """Receipts with their logs; each is there twice, of which the second, with the true status, counts."""
    logs = v.logs().select("tx", F.struct("address", "topics", F.concat(F.lit("0x"), "data").alias("data"), "transactionHash", "blockHash", X.to_hex(F.col("blockNumber")).alias("blockNumber"), "logIndex").alias("log"))
    logs = logs.groupBy("tx").agg(F.collect_list("log").alias("logs"))
    heights = v.transactions().select("tx", X.to_hex(F.col("blockNumber")).alias("blockNumber"), "blockHash")
    rows = v.receipts().join(heights, "tx").join(logs, "tx", "left").withColumn("status", F.concat(F.lit("0x"), "status"))
    both = F.array(F.struct(F.lit("0x1").alias("status"), F.lit("1").alias("gasUsed")), F.struct("status", "gasUsed"))
    return rows.withColumn("_r", F.explode(both)).select("transactionHash", "blockNumber", "blockHash", "_r.status", "_r.gasUsed", "logs")


def root(v: ChainView) -> str:
    """Tables that ingest() has filled from landing files of this view, once a session."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _ROOTS:
        base = shared_folder(v.spark, "landed")
        raw_receipts(v).write.option("compression", "gzip").option("maxRecordsPerFile", LINES).json(f"{base}/receipts")
        raw_blocks(v).write.option("compression", "gzip").json(f"{base}/blocks")
        stream.ingest(v.spark, f"{base}/blocks", f"{base}/receipts", f"{base}/tables", CHAIN, f"{base}/checkpoint", 1_000_000).awaitTermination()
        _ROOTS[key] = f"{base}/tables"
    return _ROOTS[key]


_LATE: dict[tuple[str, str], str] = {}
PARTS = 3


def late_root(v: ChainView) -> str:
    """Tables filled in four landings that bring blocks and receipts in different orders, with lines that are broken, and
    closed by a call that writes what still waits; once a session."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _LATE:
        base = shared_folder(v.spark, "landed-late")
        n = F.col("n")
        blocks = raw_blocks(v).withColumn("n", X.to_int(F.col("number")))
        broken = blocks.where(n % 40 == 0).select(n, F.concat(F.lit("{broken "), n.cast("string")).alias("value"))
        misread = blocks.where(n % 40 == 1).select(n, F.to_json(F.struct(F.concat(F.lit("0xzz"), n.cast("string")).alias("number"), "hash")).alias("value"))
        nameless = blocks.where(n % 40 == 2).select(n, F.to_json(F.struct("number")).alias("value"))
        whole = blocks.select(n, F.to_json(F.struct(*(c for c in blocks.columns if c != "n"))).alias("value"))
        twice = blocks.where(n % 40 == 3).select(n, F.to_json(F.struct("number", F.lit("0xother").alias("hash"))).alias("value"))
        first = whole.unionByName(broken).unionByName(misread).unionByName(nameless).withColumn("part", n * 7 % PARTS)
        lines = first.unionByName(twice.withColumn("part", F.lit(PARTS).cast("long")))  # at heights that are there by then
        receipts = raw_receipts(v)
        of_receipts = receipts.select(F.to_json(F.struct(*receipts.columns)).alias("value"), F.pmod(F.crc32("transactionHash"), F.lit(PARTS)).alias("part"))
        lines.select("value", "part").write.partitionBy("part").option("compression", "gzip").text(f"{base}/all/blocks")
        of_receipts.write.partitionBy("part").option("compression", "gzip").option("maxRecordsPerFile", LINES).text(f"{base}/all/receipts")
        for i in range(PARTS + 1):
            for kind in ("blocks", "receipts"):
                move(v.spark, f"{base}/all/{kind}/part={i}", f"{base}/{kind}/part={i}")
            closing = {} if i == PARTS else {"wait": "1 hour"}
            stream.ingest(v.spark, f"{base}/blocks", f"{base}/receipts", f"{base}/tables", CHAIN, f"{base}/checkpoint", 1_000_000, **closing).awaitTermination()
        _LATE[key] = f"{base}/tables"
    return _LATE[key]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder, if it is there."""
    one, fs = file_system(spark, source)
    other, _ = file_system(spark, target)
    if fs.exists(one):
        fs.mkdirs(other.getParent())
        fs.rename(one, other)


def copied(v: ChainView, name: str, *tables: str) -> str:
    """A copy of landed tables, to change; rows stay in the order of their hashes that they lie in."""
    base = shared_folder(v.spark, name)
    for of in tables:
        append_new(table(v, of), base, of, CHAIN, unique=True, stay=True)
    return base


def pruned(v: ChainView, keep: int) -> str:
    """A copy of the landed tables after a retention by range."""
    base = copied(v, "landed-pruned", "Block", "Transaction", "Log", "AccessListEntry", "BlockSignature")
    cutoff = retention.by_range(scan(v.spark, base, "Block", CHAIN), keep).first()["cutoff"]
    retention.prune(v.spark, base, CHAIN, cutoff)
    return base


def drained(df: DataFrame, name: str) -> DataFrame:
    """What a stream gives out over all that is there."""
    base = shared_folder(df.sparkSession, name)
    df.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/rows")


def subscribed(v: ChainView, of: str) -> DataFrame:
    """Rows that a subscriber of the chain gets, with another chain's rows in the same table and files that are written twice."""
    base = copied(v, "landed-watched", of)
    append_new(table(v, of).withColumn("doc_id", F.concat(F.lit("other-"), "doc_id")), base, of, "Other__Net", unique=True, stay=True)
    again = scan(v.spark, base, of, CHAIN, meta=True).where(F.col("block_bucket") % 2 == 0).withColumn("chain", F.lit(CHAIN))
    write(again, base, of, stay=True)  # the same commits in more files
    return drained(stream.subscribe(v.spark, base, of, CHAIN), "subscribed")


def released(v: ChainView) -> DataFrame:
    """Results of the chain's heights, every seventh one failed, released in order from a stream without any."""
    base = shared_folder(v.spark, "results")
    rows = v.heads().select("chain", F.dense_rank().over(W.partitionBy("chain").orderBy("number")).cast("long").alias("number"), "success")
    rows = rows.where("number % 1499 <> 0 or number < 3000").withColumnRenamed("success", "ok").withColumn("lot", F.pmod(F.xxhash64("number"), F.lit(3)))
    rows.write.partitionBy("lot").parquet(base)
    src = v.spark.readStream.schema("chain string, number long, ok boolean, lot int").parquet(base)
    return drained(stream.in_order(src, 1), "released")


def grown_roots(v: ChainView, signatures: DataFrame, per_group: int) -> DataFrame:
    """Roots of groups of heights that grow in three steps; the last root of each."""
    base = shared_folder(v.spark, "grown")
    low, high = signatures.agg(F.min("blockNumber"), F.max("blockNumber")).first()
    out, step = None, (high - low) // 3 + 1
    for i in range(3):
        part = signatures.where(F.col("blockNumber").between(low + i * step, low + (i + 1) * step - 1))
        more = snapshot.grow_roots(v.spark, base, CHAIN, part, F.expr(f"blockNumber div {per_group}"), i).withColumn("step", F.lit(i))
        out = more if out is None else out.unionByName(more)
    return out.groupBy("group").agg(F.max_by(F.struct("n", "root"), "step").alias("r")).select("group", "r.n", "r.root")


def roots_folder(v: ChainView, signatures: DataFrame, per_file: int) -> str:
    """A JSON-lines file a range of heights, with other records and broken lines among the roots."""
    base = shared_folder(v.spark, "roots")
    start = F.expr(f"blockNumber div {per_file} * {per_file}")
    record = lambda kind: F.to_json(F.struct(F.lit(kind).alias("type"), F.struct("merkleRoot", "blockNumber").alias("data")))
    lines = F.array(record("block_signature"), record("other"), F.concat(F.lit("{broken "), F.col("blockNumber").cast("string")))
    signatures.select(start.alias("start"), F.explode(lines).alias("value")).repartition(1, "start").write.partitionBy("start").text(f"{base}/all")
    folder, fs = file_system(v.spark, f"{base}/all")
    target, _ = file_system(v.spark, f"{base}/files")
    fs.mkdirs(target)
    for status in fs.listStatus(folder):  # one a range
        name = status.getPath().getName()
        if name.startswith("start="):
            low = int(name.split("=")[1])
            for part in fs.listStatus(status.getPath()):
                to, _ = file_system(v.spark, f"{base}/files/snapshot_{low}_{low + per_file - 1}.jsonl")
                fs.rename(part.getPath(), to)
    return f"{base}/files"


def restored(v: ChainView, per_file: int) -> str:
    """Tables restored from an export of all complete ranges of the landed ones, one of them twice."""
    base, out = shared_folder(v.spark, "restored"), shared_folder(v.spark, "exported")
    blocks = table(v, "Block")
    plan = snapshot.plan(blocks, per_file)
    manifest = snapshot.export({of: table(v, of) for of in ("Block", "Transaction", "Log", "AccessListEntry")}, plan, out, chain=CHAIN)
    files = [r[0] for r in manifest.orderBy("start").select("snapshotFile").limit(3).collect()]
    for f in [*files, *files[:1]]:
        snapshot.restore(v.spark, out, f, base, CHAIN)
    return base


def table(v: ChainView, of: str, heights: tuple[int, int] | None = None) -> DataFrame:
    return scan(v.spark, root(v), of, CHAIN, heights)
