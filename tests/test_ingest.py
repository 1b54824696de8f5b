import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import normalize, ops, retention
from ledgerloom.sources import index, tables
from ledgerloom.streaming import ingest, staging, stream
from ledgerloom.streaming.ingest import ledger
from ledgerloom.streaming.turnstile import TurnstileReader, admitted

from test_tables import raw_block, raw_tx, receipt, write

@pytest.fixture(autouse=True)
def small(spark):
    """Many small plans: to compile them takes longer than to run them."""
    names = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


TABLES = ("Block", "Transaction", "Log", "AccessListEntry", "BlockSignature")


def h(n, kind="a"):
    return f"0x{kind}{n:063x}"


def land(path, rows):
    """Files of one landing come later than those before."""
    write(path, rows)
    time.sleep(0.02)


def chain_of(n, txs=3, first=10, bare=()):
    """Blocks with transactions and the receipts of these."""
    blocks, receipts = [], []
    for b in range(first, first + n):
        hashes = [h(b * 100 + i) for i in range(0 if b in bare else txs)]
        blocks.append(raw_block(b, [raw_tx(x) | {"to": f"0xto{b % 3}", "from": f"0xfrom{b}"} for x in hashes], hash=h(b, "b")))
        receipts += [receipt(x, b, first=2 * i, logs=2, blockNumber=hex(b)) | {"logs": [{"address": "0xc", "topics": [f"0xt{b % 4}"], "data": "0xdd", "blockNumber": hex(b), "transactionHash": x, "blockHash": h(b, "b"), "logIndex": 2 * i + k} for k in range(2)]} for i, x in enumerate(hashes)]
    return blocks, receipts


class Chain:
    """Folders of one ingest."""

    def __init__(self, spark, path, chain="c"):
        self.spark, self.path, self.root, self.chain, self.n = spark, path, str(path / "t"), chain, 0
        for d in ("b", "r"):
            (path / d).mkdir(parents=True)

    def land(self, blocks=(), receipts=()):
        self.n += 1
        if blocks:
            land(self.path / f"b/{self.n:03}.json", blocks)
        if receipts:
            land(self.path / f"r/{self.n:03}.json", receipts)
        return self

    def go(self, **more):
        q = stream.ingest(self.spark, str(self.path / "b"), str(self.path / "r"), self.root, self.chain, str(self.path / "cp"), created_at=F.lit("now"), **more)
        if "every" not in more and "per_minute" not in more:
            q.awaitTermination()
        return q

    def table(self, of):
        return tables.scan(self.spark, self.root, of, self.chain)

    def content(self):
        return {of: Counter(map(str, self.table(of).collect())) for of in TABLES}

    def numbers(self):
        return sorted(r["number"] for r in self.table("Block").select("number").collect())


def test_any_order_of_landing_gives_the_same_tables(spark, tmp_path):
    blocks, receipts = chain_of(12, bare=(13, 17))
    receipts = [r for r in receipts if r["transactionHash"] != h(1501)]  # one never comes
    once = Chain(spark, tmp_path / "once").land(blocks, receipts)
    once.go()
    r = random.Random(4)
    late = Chain(spark, tmp_path / "late")
    b, c = r.sample(blocks, len(blocks)), r.sample(receipts, len(receipts))
    seen = []
    for i in range(5):
        late.land(b[i::5], c[i::5])
        late.go(wait="1 hour")
        seen.append(late.numbers())
    assert seen[0] != seen[-1] and 15 not in seen[-1] and len(seen[-1]) == 11  # all but the one that still waits
    late.go()  # closes: what waits is written with what came
    assert late.content() == once.content() and len(late.numbers()) == 12
    missing = {x["number"]: x["missing_receipts"] for x in ledger(spark, late.root, "c").collect()}
    assert missing == {n: int(n == 15) for n in range(10, 22)}


def test_a_block_is_written_when_its_wait_is_over(spark, tmp_path):
    blocks, receipts = chain_of(4)
    c = Chain(spark, tmp_path)
    c.land(blocks[:2], receipts[:5])  # the second lacks a receipt
    c.go(wait="3 seconds")
    assert c.numbers() == [10]
    time.sleep(4)
    c.land(blocks[2:3], receipts[6:9])
    c.go(wait="3 seconds")
    c.land(blocks[3:], receipts[9:])
    c.go(wait="3 seconds")
    assert c.numbers() == [10, 11, 12, 13] and ledger(spark, c.root, "c").where("number = 11").first()["missing_receipts"] == 1


def test_every_line_is_stored_skipped_or_rejected(spark, tmp_path):
    blocks, receipts = chain_of(5)
    bad_blocks = ["{broken", json.dumps(raw_block(30, number="0xzz", hash="0x1")), json.dumps({"number": "0x5"}), "null", "[1, 2"]
    bad_receipts = ["{", json.dumps(receipt("0x1") | {"blockNumber": "zz"}), json.dumps({"status": "0x1"})]
    c = Chain(spark, tmp_path)
    c.land([*map(json.dumps, blocks), *bad_blocks, "", "  ", json.dumps(blocks[0] | {"hash": h(7, "f")})], [*map(json.dumps, receipts), *bad_receipts])
    c.go()
    c.land([json.dumps(blocks[1]), "{again"])
    c.go()
    out = staging.rejects(spark, c.root, "c").collect()
    assert Counter((r["operation"], r["code"]) for r in out) == {("blocks", "PARSING_FAILED"): 4, ("blocks", "INVALID_HEX"): 1, ("blocks", "INVALID_BLOCK_FORMAT"): 1, ("receipts", "PARSING_FAILED"): 1, ("receipts", "INVALID_HEX"): 1, ("receipts", "INVALID_INPUT_FORMAT"): 1}
    assert {r["raw"] for r in out if r["operation"] == "blocks"} == {*bad_blocks, "{again"} and all(r["file"].endswith(".json") and r["severity"] == "error" for r in out)
    log = ops.run_log(spark, c.root, "c").groupBy("job").agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), F.sum("skipped").alias("skipped"), F.sum("blocks").alias("blocks")).collect()
    log = {r["job"]: r for r in log}
    stored = c.table("Block").count()
    assert log["stage-blocks-1"]["rows"] == 5 + 5 + 1 + 2 == stored + log["ingest"]["skipped"] + log["stage-blocks-1"]["rejected"] and log["ingest"]["blocks"] == stored == 5
    assert c.table("Block").where("number = 10").first()["hash"] == blocks[0]["hash"]  # the first line of a height


def test_replayed_staging_rejects_once(spark, tmp_path):
    c = Chain(spark, tmp_path)
    c.land(["{bad"])
    s = staging.Staging(spark, str(tmp_path / "staged"), c.root, "c")
    lines = spark.read.text(str(tmp_path / "b"))
    part = lines.metadataColumn("_metadata")
    rows = lines.select("value", F.struct(part["file_modification_time"].alias("time"), part["file_path"].alias("path"), part["file_block_start"].alias("start")).alias("file"))
    for _ in range(2):
        s._put(staging.BLOCKS, rows, 0, 1)
    assert staging.rejects(spark, c.root, "c").count() == 1 and s.rows(staging.BLOCKS, [staging.BAD]).count() == 1


def test_a_short_block_stays_without_attestation(spark, tmp_path):
    c = Chain(spark, tmp_path)
    c.land(*chain_of(3))
    c.go()
    part = tmp_path / "t/BlockSignature"
    part.rename(tmp_path / "gone")
    lost = c.table("Log").where("blockNumber = 11").count()
    kept = [r.asDict() for r in c.table("Log").where("blockNumber <> 11").collect()]
    (tmp_path / "t/Log").rename(tmp_path / "gone_logs")
    tables.add(spark, c.root, "Log", "c", kept)  # block 11 has fewer documents than were expected of it
    c.land([raw_block(n, hash=h(n, "b")) for n in (10, 11, 12, 13)])
    c.go()
    assert lost and sorted(r["blockNumber"] for r in c.table("BlockSignature").collect()) == [10, 12, 13]


def test_stray_heights_read_their_own_buckets(spark, tmp_path):
    c = Chain(spark, tmp_path)
    c.land([raw_block(5, hash=h(5, "b")), raw_block(5_000_000_000, hash=h(6, "b"))])
    c.go()
    assert c.numbers() == [5, 5_000_000_000] and c.table("BlockSignature").count() == 2


# --- layout and index ---


def scanned(df):
    """Rows and files that the scans of a finished query read."""
    rows = files = 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.finalPhysicalPlan())
            continue
        if hasattr(node, "metrics") and "Scan parquet" in node.nodeName():
            m = node.metrics()
            rows += m.apply("numOutputRows").value()
            files += m.apply("numFiles").value()
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows, files


def test_a_lookup_by_hash_reads_few_row_groups(spark, tmp_path):
    """1,000 files of 50 rows: row groups are passed by for their range of hashes or by their Bloom filter."""
    rows = spark.range(50_000).select(F.concat(F.lit("0x"), F.sha2(F.col("id").cast("string"), 256)).alias("hash"), (F.col("id") % 5 * 1000).alias("blockNumber"))
    full = tables.with_ids(rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in tables.TABLES["Transaction"].fields)))
    out = full.withColumns({"commit": F.lit(1).cast("long"), "chain": F.lit("c"), "block_bucket": F.expr("blockNumber div 1000")})
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    try:
        tables.write(out, str(tmp_path), "Transaction")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(list((tmp_path / "Transaction").rglob("*.parquet"))) >= 1000
    wanted = full.select("hash").orderBy("doc_id").first()[0]
    df = tables.scan(spark, str(tmp_path), "Transaction", "c").where(F.col("hash") == wanted)
    assert len(df.collect()) == 1
    assert 1 <= scanned(df)[0] <= 10 * 50


def test_reads_by_topic_and_address_prune_folders(spark, tmp_path):
    c = Chain(spark, tmp_path)
    blocks, receipts = [], []
    for first in range(0, 20_000, 1000):
        b, r = chain_of(2, txs=2, first=first + 7)
        blocks, receipts = blocks + b, receipts + r
    for r in receipts:
        for x in r["logs"]:
            x["topics"] = ["0xrare" if x["blockNumber"] == hex(3007) else "0xcommon", f"0xp{int(x['blockNumber'], 16)}"]
    for b in blocks:
        for t in b["transactions"]:
            t["to"] = "0xfriend" if b["number"] in (hex(4007), hex(15_008)) else "0xother"
    c.land(blocks, receipts).go()
    for topic in ("0xrare", "0xcommon", "0xnone"):
        got = index.logs_by_topic(spark, c.root, "c", topic)
        want = c.table("Log").where(F.array_contains("topics", topic))
        assert Counter(map(str, got.collect())) == Counter(map(str, want.collect())) and len(got.collect()) == {"0xrare": 4, "0xcommon": 156, "0xnone": 0}[topic]
    rare = index.logs_by_topic(spark, c.root, "c", "0xrare")
    rare.collect()
    whole = c.table("Log").where(F.array_contains("topics", "0xrare"))
    whole.collect()
    assert scanned(rare)[1] <= 3 and scanned(whole)[1] >= 20  # its folder and the index's, against all
    friend = index.transactions_of(spark, c.root, "c", "0xfriend")
    assert sorted({r["blockNumber"] for r in friend.collect()}) == [4007, 15_008] and scanned(friend)[1] <= 4
    before = spark.read.parquet(f"{c.root}/Index").count()
    index.build(spark, c.root, "c")
    index.compact(spark, c.root, "c")
    assert spark.read.parquet(f"{c.root}/Index").count() == before and len(index.logs_by_topic(spark, c.root, "c", "0xrare").collect()) == 4


# --- floors ---


def test_readers_are_whole_wherever_a_prune_stops(spark, tmp_path, monkeypatch):
    c = Chain(spark, tmp_path)
    blocks, receipts = [], []
    for first in (995, 2500):
        b, r = chain_of(10, txs=2, first=first)
        blocks, receipts = blocks + b, receipts + r
    c.land(blocks, receipts).go()

    def whole():
        heights = set(c.numbers())
        for of in ("Transaction", "Log", "BlockSignature"):
            assert {r[0] for r in c.table(of).select("blockNumber").distinct().collect()} == heights
        return heights

    assert len(whole()) == 20
    real, calls = retention._drop_below, []
    for stop in range(6):
        cutoff = 1000 + stop * 300

        def cut(*a, stop=stop):
            calls.append(a[2])
            if len(calls) % 7 > stop:
                raise KeyboardInterrupt
            real(*a)

        monkeypatch.setattr(retention, "_drop_below", cut)
        calls.clear()
        try:
            retention.prune(spark, c.root, "c", cutoff)
        except KeyboardInterrupt:
            pass
        assert whole() == {n for n in [*range(995, 1005), *range(2500, 2510)] if n > cutoff}
    monkeypatch.setattr(retention, "_drop_below", real)
    retention.prune(spark, c.root, "c", 2499)
    assert not list((tmp_path / "t").glob("*/chain=c/block_bucket=0")) and tables.floor(spark, c.root, "c") == 2501
    c.land(*chain_of(1, first=996)).go()  # a height below the floor does not come back
    assert min(c.numbers()) == 2501


# --- rates ---


def test_no_minute_admits_more_than_the_cap(tmp_path):
    now = [1000.0]
    reader = TurnstileReader(60, str(tmp_path / "note.json"), lambda: now[0])
    passes, at, total = [], 0, 0
    for step in range(60):
        end = reader.latestOffset()["passed"]
        passes.append((now[0], end - total))
        total = end
        now[0] += 10 if step % 7 else 23
        if step == 30:  # a restart does not begin a new minute
            reader = TurnstileReader(60, str(tmp_path / "note.json"), lambda: now[0])
    assert total > 300
    for t, _ in passes:
        assert sum(n for u, n in passes if t <= u < t + 60) <= 60
    assert admitted([[0.0, 5], [100.0, 7]], 110.0, 10) == 3


def test_blocks_go_in_order_at_the_rate(spark, tmp_path):
    blocks, _ = chain_of(40, txs=0)
    c = Chain(spark, tmp_path)
    c.land(blocks[20:]).land(blocks[:20])
    q = c.go(per_minute=15, every="2 seconds")
    q.processAllAvailable()
    assert c.numbers() == list(range(10, 25))
    time.sleep(5)
    assert c.numbers() == list(range(10, 25))  # the minute is used up
    q.stop()
    c.go()
    assert c.numbers() == list(range(10, 50))


@pytest.mark.parametrize("of", ["Block", "Log"])
def test_rows_keep_their_commit(spark, tmp_path, of):
    c = Chain(spark, tmp_path)
    c.land(*chain_of(2)).go()
    assert tables.scan(spark, c.root, of, "c", meta=True).where("commit is null or block_bucket is null").count() == 0


def test_logs_that_name_another_transaction_hang_on_it(spark, tmp_path):
    """A log hangs on the transaction that it names, whichever receipt brings it; one that names none is left out."""
    blocks, receipts = chain_of(2, txs=2)
    moved, nameless = receipts[0]["logs"][0], receipts[1]["logs"][0]
    moved["transactionHash"], nameless["transactionHash"] = receipts[1]["transactionHash"], None
    c = Chain(spark, tmp_path).land(blocks, receipts)
    c.go()
    tx = {r["hash"]: (r["doc_id"], r["block_id"]) for r in c.table("Transaction").collect()}
    got = Counter((r["transaction_id"], r["block_id"], r["logIndex"]) for r in c.table("Log").collect())
    want = Counter((*tx[x["transactionHash"]], x["logIndex"]) for r in receipts for x in r["logs"] if x["transactionHash"])
    assert got == want and sum(want.values()) == 7


def test_the_block_that_was_staged_first_counts(spark, tmp_path):
    """Of two blocks at one height that wait together, the one of the earlier landing is written, whatever the times of their files."""
    blocks, receipts = chain_of(2)
    c = Chain(spark, tmp_path).land(blocks, receipts[:-1])
    c.go(wait="1 hour")
    assert c.numbers() == [10]
    c.land([raw_block(11, hash=h(9, "f"))])
    os.utime(tmp_path / "b/002.json", (1_000_000_000, 1_000_000_000))
    c.go()
    assert {r["number"]: r["hash"] for r in c.table("Block").collect()} == {n: h(n, "b") for n in (10, 11)} and c.table("Transaction").count() == 6


def test_receipts_move_once_as_bytes(spark, tmp_path):
    """Transactions meet their receipts by one shuffle of both, and which receipt is the last is seen there."""
    blocks, receipts = chain_of(3)
    receipts = [x for r in receipts for x in (r | {"status": "0x0", "logs": []}, r)]
    c = Chain(spark, tmp_path).land(blocks, receipts)
    s = staging.Staging(spark, str(tmp_path / "staged"), c.root, "c")
    for kind, folder in ((staging.BLOCKS, "b"), (staging.RECEIPTS, "r")):
        s.stage(kind, str(tmp_path / folder)).awaitTermination()
    work = ingest.Commit(s, str(tmp_path / "work"), F.lit("now"))
    raw = s.rows(staging.BLOCKS, [0])
    whole = work._whole(raw, tables.with_ids(normalize.blocks(raw)), [0])
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "unhex" in plan.split("RepartitionByExpression", 1)[1]
    got = whole.collect()
    assert sorted(r["hash"] for r in got) == sorted(t["hash"] for b in blocks for t in b["transactions"])
    assert all(r["status"] and r["has_receipt"] and len(r["logs"]) == 2 and len(r["entries"]) == 1 and r["entries"][0]["storageKeys"] == ["0x1", "0x2"] for r in got)


def test_rows_move_to_their_keys_only_where_keys_meet(spark, tmp_path):
    rows = lambda n: tables.with_ids(spark.createDataFrame([{f.name: None for f in tables.TABLES["Log"].fields} | {"blockHash": "0x1", "logIndex": i, "blockNumber": 5} for i in n], tables.TABLES["Log"]))
    for part, moved in (((1, 2), False), ((3, 4), False), ((4, 5, 5), True)):
        new = tables.append_new(rows(part), str(tmp_path), "Log", "c")
        assert ("Aggregate" in (plan := new._jdf.queryExecution().optimizedPlan().toString())) == moved and ("LeftAnti" in plan) == moved
    assert sorted(r["logIndex"] for r in tables.scan(spark, str(tmp_path), "Log", "c").collect()) == [1, 2, 3, 4, 5]


def test_what_waits_is_one_store_a_partition(spark, tmp_path):
    """Keys that wait for each other lie in one store, of which a batch writes what it changed."""
    blocks, receipts = chain_of(2)
    c = Chain(spark, tmp_path).land(blocks, receipts[:-1])
    c.go(wait="1 hour")
    state = list((tmp_path / "cp/commit-waiting/state/0").rglob("*"))
    assert any(p.suffix == ".changelog" for p in state) and not any("keyToNumValues" in p.name or "keyWithIndexToValue" in p.name for p in state)
    assert len(list((tmp_path / "cp-commit-waiting-work/rows").glob("batch=*"))) >= 1 and c.numbers() == [10]
