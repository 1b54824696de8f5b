"""Tail ingest: landing files to staged rows, staged rows to tables, block by block and exactly once by height."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from ..functions.expr import content_doc_id, content_id, pack, unpack
from ..operators import assemble, attest, intervals, normalize, ops
from ..sources import index
from ..sources.schema import EXPECTED, IDS, TABLES
from ..sources.tables import BUCKET, append_new, bucket_of, file_system, floor, read, repeated, scan, with_ids
from .staging import BLOCKS, NOWHERE, RECEIPTS, Staging, staged_schema
from .turnstile import Turnstile

#: a block's line with one of its transactions that has what it waits for; n_txs of them make it complete
ARRIVED = "height long, hash string, stage long, place struct<time: timestamp, path: string, start: long, line: long>, tx string, n_txs int"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WAITING = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.streaming.join.stateFormatVersion": "3"}
#: transactions of a batch whose keys are given to all tasks, 8 bytes each
KEYS = 1 << 20
#: buckets of a batch up to which each task that has its rows writes a file for each of them
FEW = 8


# --- the ledger of expected documents ---


def ledger(spark: SparkSession, root: str, chain: str, buckets: list[int] | None = None) -> DataFrame:
    """number, txs, logs, entries, missing_receipts, expected_docs of each block that was written."""
    names = EXPECTED.fieldNames()
    df = read(spark, f"{root}/Expected", f"{', '.join(f'{n} long' for n in names)}, chain string, block_bucket long").where(F.col("chain") == chain)
    return (df if buckets is None else df.where(F.col("block_bucket").isin(buckets))).select(*names)


def enter(expected: DataFrame, root: str, chain: str, buckets: list[int]) -> None:
    new = expected.join(ledger(expected.sparkSession, root, chain, buckets).select("number"), "number", "left_anti")
    new.select(*EXPECTED.fieldNames(), F.lit(chain).alias("chain"), bucket_of("number").alias("block_bucket")).hint("rebalance", "block_bucket").write.mode("append").partitionBy("chain", "block_bucket").parquet(f"{root}/Expected")


def attest_stored(spark: SparkSession, root: str, chain: str, numbers: DataFrame, buckets: list[int], created_at: Column) -> None:
    """Writes attestations of the stored blocks among numbers (number) that have none.

    A block has to have a content id for each document, and where the ledger has it as many documents as were expected
    when it was written, in whichever batch that was.
    """
    get = lambda of: scan(spark, root, of, chain, buckets=buckets)
    blocks = attest.backfill(get("Block"), get("BlockSignature")).join(numbers, "number", "left_semi").select("number", "hash")
    docs = attest.documents(get("Block"), get("Transaction"), get("Log"), get("AccessListEntry")).join(blocks.select(F.col("number").alias("blockNumber")), "blockNumber", "left_semi")
    whole = attest.coverage(docs).where("status = 'ok'").select(F.col("blockNumber").alias("number"), "docs")
    whole = whole.join(ledger(spark, root, chain, buckets).select("number", "expected_docs"), "number", "left").where("docs = coalesce(expected_docs, docs)")
    records = attest.block_records(docs.join(whole.select(F.col("number").alias("blockNumber")), "blockNumber", "left_semi"), blocks, created_at)
    append_new(records, root, "BlockSignature", chain, buckets=buckets, unique=True, fresh=True, stay=len(buckets) <= FEW)  # of blocks without any


# --- blocks that are ready ---


def arrivals(staging: Staging, wait: str | None) -> DataFrame:
    """Stream of ARRIVED rows: with a wait, a transaction once its receipt is staged or the wait is over; without, blocks at once.

    Keys only pass through the join's state; receipts are read where they are staged when their block is written. The
    wait is counted in staging time, which moves on as blocks land.
    """
    blocks = staging.stream(BLOCKS)
    if wait is None:
        return blocks.select("height", "hash", "stage", "place", F.lit(None).cast("string").alias("tx"), F.lit(0).alias("n_txs"))
    hashes = F.filter("transactions.hash", lambda h: h.isNotNull())
    rows = blocks.select("height", "hash", "stage", "place", "staged_at", F.coalesce(F.size(F.array_distinct(hashes)), F.lit(0)).alias("n_txs"), F.explode_outer(F.array_distinct(hashes)).alias("tx"))
    waiting = rows.where("tx is not null").withWatermark("staged_at", "0 seconds")
    beat = blocks.select(F.lit(None).cast("string").alias("got"), F.col("staged_at").alias("got_at"))  # receipts that stay away hold nothing up
    got = staging.stream(RECEIPTS).select(F.col("transactionHash").alias("got"), F.col("staged_at").alias("got_at")).unionByName(beat).withWatermark("got_at", "0 seconds")
    near = F.expr(f"tx = got AND got_at BETWEEN staged_at - INTERVAL {wait} AND staged_at + INTERVAL {wait}")
    out = waiting.join(got, near, "leftOuter").select("height", "hash", "stage", "place", "tx", "n_txs")
    return out.unionByName(rows.where("tx is null").select("height", "hash", "stage", "place", "tx", F.lit(0).alias("n_txs")))


@dataclass
class Commit:
    """Writes blocks that are ready, once a height; what waits lies in a folder a batch, the last two of which are kept."""

    staging: Staging
    path: str
    created_at: Column
    counts: dict = field(default_factory=dict)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, root, chain = self.staging.spark, self.staging.root, self.staging.chain
        rated = "passes" in batch.columns
        names = ["height", "hash", "stage", "place", "tx", "n_txs"]
        new = batch.select(*names, *(["passes"] if rated else [])).unionByName(self._waiting(number), allowMissingColumns=True)
        new = new.groupBy(*names).agg(F.sum("passes").alias("passes")) if rated else new.distinct()
        path = f"{self.path}/rows/batch={number}"  # the batch is worked out once, with the state of its join
        new.write.mode("overwrite").option("compression", "zstd").parquet(path)
        whole = spark.read.schema(new.schema).parquet(path)
        passes = whole.agg(F.sum("passes")).first()[0] if rated else None
        rows = whole.where("height is not null").select(*names)
        ready = rows.groupBy("height", "hash", "stage", "place").agg(F.count_distinct("tx").alias("n"), F.max("n_txs").alias("n_txs")).where("n >= n_txs").select("height", "hash", "stage", "place").persist()
        buckets = [r[0] for r in ready.select(F.expr(f"height div {BUCKET}")).distinct().collect()]  # 8 bytes for each 1000 heights of a batch
        low = floor(spark, root, chain)
        lines, blocks = ready.count(), 0
        done = ready
        if buckets:
            first = ready.groupBy("height").agg(F.min(F.struct("stage", "place")).alias("f")).select("height", "f.*")  # what was staged before comes first, whatever the times of files
            fresh = first.join(scan(spark, root, "Block", chain, buckets=buckets).select(F.col("number").alias("height")), "height", "left_anti")
            fresh = fresh if low is None else fresh.where(F.col("height") >= low)
            if passes is not None:
                fresh = fresh.orderBy("height").limit(int(passes))
            chosen_path = f"{self.path}/chosen/batch={number}"
            fresh.write.mode("overwrite").parquet(chosen_path)
            chosen = spark.read.schema(fresh.schema).parquet(chosen_path)
            if passes is not None:  # heights that have to wait for another minute
                stored = scan(spark, root, "Block", chain, buckets=buckets).select(F.col("number").alias("height"))
                done = ready.join(chosen.select("height").unionByName(stored), "height", "left_semi").persist()
                lines = done.count()
            blocks = self._write(chosen, buckets, number) if chosen.head(1) else 0
            attest_stored(spark, root, chain, done.select(F.col("height").alias("number")).distinct(), buckets, self.created_at)
        left = rows.join(done.select("height"), "height", "left_anti") if lines else rows
        left.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/waiting/batch={number}")
        self._forget(number - 2)
        ops.log_run(spark, root, "ingest", number, chain, self._part(number), rows=lines, skipped=lines - blocks, blocks=blocks, docs=self.counts.pop("docs", 0), last_block=self.counts.pop("last_block", None))
        for df in (ready, done):
            df.unpersist()

    def _part(self, number: int) -> str:
        return f"{self.path.rsplit('/', 1)[-1]}-{number}"

    def _waiting(self, number: int) -> DataFrame:
        spark = self.staging.spark
        before = max((n for n in self._batches("waiting") if n < number), default=None)
        return spark.createDataFrame([], ARRIVED) if before is None else spark.read.schema(ARRIVED).parquet(f"{self.path}/waiting/batch={before}")

    def _batches(self, of: str) -> list[int]:
        where, fs = file_system(self.staging.spark, f"{self.path}/{of}")
        return [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(where)] if fs.exists(where) else []

    def _forget(self, before: int) -> None:
        for of in ("rows", "waiting", "chosen", "blocks", "transactions"):
            for n in self._batches(of):
                if n <= before:
                    where, fs = file_system(self.staging.spark, f"{self.path}/{of}/batch={n}")
                    fs.delete(where, True)

    def _write(self, chosen: DataFrame, buckets: list[int], number: int) -> int:
        """Dependents first, then blocks, so that a block that is visible has its children; returns how many blocks."""
        spark, root, chain = self.staging.spark, self.staging.root, self.staging.chain
        raw = self.staging.rows(BLOCKS, buckets).join(chosen, ["height", "stage", "place"], "left_semi")
        path = f"{self.path}/blocks/batch={number}"
        with_ids(normalize.blocks(raw)).write.mode("overwrite").option("compression", "zstd").parquet(path)
        blocks = spark.read.schema(StructType([*IDS.fields, *TABLES["Block"].fields])).parquet(path)
        path = f"{self.path}/transactions/batch={number}"  # worked out once, with logs and entries, which take their ids from it
        whole = self._whole(raw, blocks, buckets)
        whole.write.mode("overwrite").option("compression", "zstd").parquet(path)
        whole = spark.read.schema(whole.schema).parquet(path)
        tx = whole.where("block_id is not null").drop("logs", "entries")
        ids = tx.select(F.col("hash").alias("transactionHash"), F.col("doc_id").alias("transaction_id"), "block_id")
        logs = self._logs(whole, ids)
        entries = whole.where("block_id is not null").select(F.col("doc_id").alias("transaction_id"), F.explode(F.array_distinct("entries")).alias("e")).select("transaction_id", "e.*").select(*TABLES["AccessListEntry"].fieldNames())
        unique = not repeated(logs, ["blockHash", "logIndex"])  # as a rule; then logs need not meet by their key, as they do where hashes meet by chance
        own_logs = logs.select("blockNumber", "blockHash", "logIndex")
        expected = assemble.expected_docs(blocks, tx, own_logs if unique else own_logs.distinct(), entries)
        missing = tx.groupBy(F.col("blockNumber").alias("number")).agg(F.count_if(~F.col("has_receipt")).alias("missing_receipts"))
        seen = Observation()
        expected = expected.join(missing, "number", "left").na.fill(0, ["missing_receipts"])
        at = bucket_of("blockNumber")
        stay = len(buckets) <= FEW
        jobs = [
            lambda: enter(expected.observe(seen, F.count("*").alias("blocks"), F.sum("expected_docs").alias("docs"), F.max("number").alias("last_block")), root, chain, buckets),
            lambda: append_new(logs, root, "Log", chain, buckets=buckets, unique=unique, stay=stay),
            lambda: append_new(entries, root, "AccessListEntry", chain, buckets=buckets, unique=True, stay=stay),
            lambda: append_new(tx, root, "Transaction", chain, buckets=buckets, unique=True, stay=stay),
            lambda: index.add(index.entries(logs.withColumn("block_bucket", at), tx.withColumn("block_bucket", at)), root, chain),
        ]
        with ThreadPoolExecutor(len(jobs)) as pool:  # they are independent, and all before the blocks
            for done in [pool.submit(j) for j in jobs]:
                done.result()
        append_new(blocks, root, "Block", chain, buckets=buckets)
        intervals.add(chosen.select(F.col("height").alias("number")), root, chain, self._part(number))
        self.counts |= {"docs": seen.get["docs"], "last_block": seen.get["last_block"]}
        return seen.get["blocks"]

    @staticmethod
    def _logs(whole: DataFrame, ids: DataFrame) -> DataFrame:
        """Logs with the ids of the transaction that they name, which is that of their receipt; where one names another, they meet by its hash."""
        names = TABLES["Log"].fieldNames()
        rows = normalize.logs(whole.select(F.col("doc_id").alias("transaction_id"), "block_id", F.col("hash").alias("_of"), "logs"), "transaction_id", "block_id", "_of")
        own = rows.where("transactionHash = _of and block_id is not null").select(*names)
        other = rows.where("transactionHash <> _of").drop("transaction_id", "block_id")
        return own.unionByName(other.join(ids, "transactionHash").select(*names)) if other.select("_of").head(1) else own

    def _whole(self, raw: DataFrame, blocks: DataFrame, buckets: list[int]) -> DataFrame:
        """Transactions of the blocks, each once, with their ids, the logs of the last receipt that is staged, and their entries.

        Transactions and receipts move once, together, with their hex as bytes, and lie by the first digits of their hash.
        """
        own = TABLES["Transaction"].fieldNames()
        named = blocks.select(F.col("number").alias("blockNumber"), F.col("doc_id").alias("block_id"))
        tx = normalize.transactions(raw, entries=True).join(named, "blockNumber", "left")
        texts = {c: tx.schema[c].dataType for c in ("blockHash", "from", "to", "input")}
        of_entries = tx.schema["entries"].dataType
        fields = ["blockNumber", "transactionIndex", *(c for c in own if c not in ("hash", "blockNumber", "transactionIndex"))]
        t = F.struct(*(pack(F.col(c), texts[c]).alias(c) if c in texts else F.col(c) for c in fields))  # of several in one batch the first counts
        tx = tx.select(*_lot("hash"), t.alias("t"), pack(F.col("entries"), of_entries).alias("entries"))
        receipts = self._receipts(raw, buckets)
        of_logs = receipts.schema["logs"].dataType
        r = F.struct("status", "gasUsed", "cumulativeGasUsed", pack(F.col("logs"), of_logs).alias("logs"))
        rows = tx.unionByName(receipts.select(*_lot("transactionHash"), r.alias("r"), "place"), allowMissingColumns=True).repartition("lot")
        met = rows.groupBy("lot", "key").agg(F.min("t").alias("t"), F.flatten(F.collect_list("entries")).alias("entries"), F.max_by("r", "place").alias("r")).where("t is not null")
        had = {"status": F.col("r.status") == "1", "gasUsed": F.col("r.gasUsed"), "cumulativeGasUsed": F.col("r.cumulativeGasUsed")}
        value = {"hash": unpack(F.col("key"), StringType())} | {c: unpack(F.col("t")[c], texts[c]) if c in texts else F.coalesce(had[c], F.col("t")[c]) if c in had else F.col("t")[c] for c in fields}
        out = met.select(*(value[c].alias(c) for c in own), F.col("r").isNotNull().alias("has_receipt"), unpack(F.col("r.logs"), of_logs).alias("logs"), unpack(F.col("entries"), of_entries).alias("entries"))
        return out.withColumn("cid", content_id(*own)).select(content_doc_id(F.col("cid")).alias("doc_id"), "cid", *own, "has_receipt", "logs", "entries")

    def _receipts(self, raw: DataFrame, buckets: list[int]) -> DataFrame:
        """Staged receipts with their place among all; where the blocks have few transactions, only those of these, but for
        some whose hashes meet by chance in 64 bits."""
        rows = normalize.receipts(self.staging.rows(RECEIPTS, [*buckets, NOWHERE]).withColumn("place", F.struct("preferred", "stage", "place")))
        n = raw.agg(F.sum(F.greatest(F.size("transactions"), F.lit(0)))).first()[0] or 0
        if n > KEYS:
            return rows
        mine = raw.select(F.explode("transactions.hash").alias("_h")).select(F.xxhash64("_h").alias("_k")).distinct()
        return rows.withColumn("_k", F.xxhash64("transactionHash")).join(F.broadcast(mine), "_k", "left_semi").drop("_k")


def _lot(hash_: str) -> list[Column]:
    """lot, key: the first digits of a hash, by which rows are dealt, and the hash as bytes."""
    return [F.substring(hash_, 1, 5).alias("lot"), pack(F.col(hash_), StringType()).alias("key")]


@dataclass
class Running:
    """The queries of an ingest as one."""

    stages: list[StreamingQuery]
    commit: StreamingQuery
    rated: bool = False

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        return self.commit.awaitTermination(timeout)

    def processAllAvailable(self) -> None:
        """Returns when what had landed is in the tables; with a rate, when a batch that began after the call has run."""
        for s in self.stages:
            s.processAllAvailable()
        if not self.rated:
            self.commit.processAllAvailable()
            return
        began = self.commit.lastProgress["batchId"] if self.commit.lastProgress else -1
        while self.commit.isActive and (self.commit.lastProgress["batchId"] if self.commit.lastProgress else -1) <= began:
            self.commit.awaitTermination(0.2)

    def stop(self) -> None:
        for q in (*self.stages, self.commit):
            q.stop()

    @property
    def isActive(self) -> bool:
        return self.commit.isActive

    @property
    def lastProgress(self):
        return self.commit.lastProgress


def ingest(
    spark: SparkSession, blocks_dir: str, receipts_dir: str, root: str, chain: str, checkpoint: str, files_per_trigger: int = 100, every: str | None = None, per_minute: int | None = None, created_at: Column | None = None,
    single_receipts_dir: str | None = None, wait: str | None = None,
) -> Running:
    """Landing files to tables, exactly once by height: a height that is stored is skipped, so a replay adds nothing.

    Without `every` what has landed is taken and the query ends; with it ("10 seconds") the queries go on tailing.
    per_minute: no minute, wherever it begins, sees more blocks written than that, whatever the trigger and the sizes of
    files; blocks that have to wait go in the order of heights. wait ("10 minutes"): a block is written once receipts of
    all its transactions are staged, or when it has waited so long, with what came; the ledger counts what is missing. A
    call without wait writes all that waits.

    Of several blocks at one height the first line of the first file that was staged counts; of several receipts of a transaction the
    last, of those in single_receipts_dir only where there is no other. Lines that cannot be used are in the table Reject.
    Dependents are written before blocks, so a block that is visible has its children; attestations come last, for blocks
    that have all documents the ledger expects, also for those stored earlier that lack one.
    """
    staging = Staging(spark, f"{checkpoint}-staged", root, chain)
    stamp = created_at if created_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if per_minute is not None:
        every = every or "10 seconds"
    trigger = {"processingTime": every} if every else {"availableNow": True}
    folders = [(RECEIPTS, receipts_dir, 1, None), (BLOCKS, blocks_dir, 1, files_per_trigger)] + ([(RECEIPTS, single_receipts_dir, 0, None)] if single_receipts_dir else [])
    for kind, folder, preferred, files in folders:  # what has landed is staged before anything is written
        staging.stage(kind, folder, preferred, files).awaitTermination()
    for kind in (BLOCKS, RECEIPTS):
        spark.createDataFrame([], staged_schema(kind)).drop("preferred", "stage").limit(0).write.mode("ignore").parquet(f"{staging.path}/{kind.name}/preferred=1/stage=-1/block_bucket={NOWHERE}")
    stages = [staging.stage(kind, folder, preferred, files, trigger) for kind, folder, preferred, files in folders] if every else []
    if wait:  # keys that wait are kept on disk, in one store a partition, and a batch writes down what it changed
        for k, v in WAITING.items():
            spark.conf.set(k, v)
    rows = arrivals(staging, wait)
    if per_minute is not None:
        spark.dataSource.register(Turnstile)
        passes = spark.readStream.format("turnstile").option("per_minute", str(per_minute)).option("note", f"{checkpoint}-turnstile.json").load()
        rows = rows.unionByName(passes, allowMissingColumns=True)
    mode = f"commit{'-waiting' if wait else ''}{'-rated' if per_minute is not None else ''}"
    commit = Commit(staging, f"{checkpoint}-{mode}-work", stamp)
    query = rows.writeStream.foreachBatch(commit).option("checkpointLocation", f"{checkpoint}/{mode}").trigger(**trigger).start()
    return Running(stages, query, per_minute is not None)
