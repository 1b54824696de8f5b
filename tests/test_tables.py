import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import assemble, attest, normalize, ops, quality, query, retention, snapshot, verify
from ledgerloom.sources import landing, schema, tables
from ledgerloom.streaming import stream


def raw_block(n, txs=(), **more):
    return {"hash": f"0xb{n}", "number": hex(n), "timestamp": "5", "logsBloom": "0x00", "extraData": "0xab", "uncles": ["0x1", None], "transactions": list(txs)} | more


def raw_tx(h, kind="2", **more):
    return {"hash": h, "from": None, "to": None, "value": "1", "gasPrice": "7", "maxFeePerGas": "9", "maxPriorityFeePerGas": "1", "input": "abcd", "type": kind, "accessList": [{"address": "0xa", "storageKeys": ["0x1", "0x2"]}]} | more


def receipt(h, n=1, status="0x1", logs=1, first=0, **more):
    return {"transactionHash": h, "status": status, "gasUsed": "21", "cumulativeGasUsed": "42", "contractAddress": "0x" + "0" * 40, "logs": [{"address": "0xc", "topics": ["0xt"], "data": "0xdd", "blockNumber": hex(n), "transactionHash": h, "blockHash": f"0xb{n}", "logIndex": first + i, "transactionIndex": 0, "removed": False} for i in range(logs)]} | more


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def test_normalise(spark, tmp_path):
    write(tmp_path / "b/1.json", [raw_block(10, [raw_tx("0x1"), None, raw_tx("0x2", "0"), raw_tx("0x3", "3")]), raw_block(11, number="zz"), "{bad"])
    raw = landing.read_raw_blocks(spark, str(tmp_path / "b"))
    b = {r["hash"]: r for r in normalize.blocks(raw).collect()}
    assert b["0xb10"]["number"] == 10 and b["0xb11"]["number"] is None and b["0xb10"]["logsBloom"] == "00" and b["0xb10"]["uncles"] == ["0x1"] and b["0xb10"]["totalDifficulty"] == ""
    assert len(raw.select("hash", "_corrupt_record").where("_corrupt_record is not null").collect()) == 1
    t = {r["hash"]: r for r in normalize.transactions(raw).collect()}
    assert [t[h]["gasPrice"] for h in ("0x1", "0x2", "0x3")] == ["9", "7", "7"] and [t[h]["maxFeePerGas"] for h in ("0x1", "0x2", "0x3")] == ["9", "", ""]
    assert t["0x2"]["transactionIndex"] == 2 and t["0x1"]["input"] == "0xabcd" and t["0x1"]["to"] == "" and t["0x1"]["from"].endswith("0" * 40) and t["0x1"]["blockNumber"] == 10
    assert normalize.access_list(raw).count() == 3
    good, bad = quality.split(normalize.blocks(raw), {"INVALID_HEX": F.col("number").isNull()}, "normalize", "blocks", F.col("number"), F.lit(None))
    assert good.count() == 1 and [r["code"] for r in bad.collect()] == ["INVALID_HEX"]


def test_receipts(spark, tmp_path):
    write(tmp_path / "r/1.json", [receipt("0x1"), receipt("0x2", status="0x0", logs=0), "null"])
    write(tmp_path / "s/1.json", [receipt("0x2", logs=5), receipt("0x3")])
    both = landing.merge_receipts(landing.read_raw_receipts(spark, str(tmp_path / "r")), landing.read_raw_receipts(spark, str(tmp_path / "s")))
    r = normalize.receipts(both)
    assert {x["transactionHash"]: (x["status"], x["contractAddress"]) for x in r.collect()} == {"0x1": ("1", ""), "0x2": ("0", ""), "0x3": ("1", "")}
    logs = normalize.logs(r).collect()
    assert len(logs) == 2 and logs[0]["data"] == "dd" and logs[0]["removed"] == "false"


def test_last_receipt_wins_and_missing_is_counted(spark):
    t = spark.createDataFrame([("a", 1), ("b", 1)], "hash string, blockNumber long")
    r = spark.createDataFrame([("a", "0", 1), ("a", "1", 2)], "transactionHash string, status string, pos int")
    got = {x["hash"]: (x["status"], x["has_receipt"]) for x in assemble.tx_receipts(t, r, "pos").collect()}
    assert got == {"a": (True, True), "b": (None, False)}


def test_append_restore_and_scan(spark, tmp_path):
    root, out = str(tmp_path / "t"), str(tmp_path / "s")
    tables.add(spark, root, "Block", "c", [{"number": n, "hash": f"h{n}"} for n in range(8, 22)])
    tables.add(spark, root, "Block", "c", [{"number": 8, "hash": "again"}])
    tables.add(spark, root, "Transaction", "c", [{"hash": f"t{n}", "blockNumber": n} for n in range(8, 22)])
    blocks = tables.scan(spark, root, "Block", "c")
    assert blocks.count() == 14 and blocks.where("number = 8").first()["hash"] == "h8" and tables.scan(spark, root, "Block", "other").count() == 0
    assert tables.scan(spark, root, "Block", "c", (9, 10)).count() == 2 and tables.scan(spark, root, "Log", "c").count() == 0
    plan = snapshot.plan(blocks, 5)
    assert [(r["start"], r["end"], r["complete"]) for r in plan.orderBy("start").collect()] == [(10, 14, True), (15, 19, True)]
    assert snapshot.plan(blocks, 5, last_end=14).count() == 1 and snapshot.plan(blocks.where("number > 100"), 5).count() == 0
    m = snapshot.export({"Transaction": tables.scan(spark, root, "Transaction", "c"), "Block": blocks}, plan, out, chain="c")
    assert m.count() == 2
    again = str(tmp_path / "again")
    for _ in range(2):
        snapshot.restore(spark, out, "snapshot_10_14", again, "c")
    want = tables.scan(spark, root, "Block", "c", (10, 14))
    got = tables.scan(spark, again, "Block", "c")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == 5
    with pytest.raises(FileNotFoundError):
        snapshot.restore(spark, out, "snapshot_1_2", again, "c")


def test_schema_only_grows(spark, tmp_path):
    tables.add(spark, str(tmp_path), "Block", "c", [{"number": 1}])
    wide = schema.StructType([*schema.IDS.fields, *schema.BLOCK.fields]).add("extra", "string")
    assert "extra" in schema.ensure(spark, str(tmp_path), "Block", wide).fieldNames()
    with pytest.raises(ValueError, match="number"):
        schema.ensure(spark, str(tmp_path), "Block", schema.StructType([f for f in wide.fields if f.name != "number"]))
    assert schema.list_collections(spark).select("collection").distinct().count() == 6
    assert schema.collection_name("Log", "X") == "X__Mainnet__Log"


def test_roots_file_and_report(spark, tmp_path):
    rec = lambda n, r, kind="block_signature": {"type": kind, "data": {"merkleRoot": r, "blockNumber": n}}
    body = "\n".join([*map(json.dumps, (rec(2, "bb"), rec(1, "aa"), rec(3, "zz"), rec(4, ""), rec(5, "cc", "other"))), "{bad"])
    with gzip.open(tmp_path / "snapshot_1_5.jsonl.gz", "wt") as f:
        f.write(body)
    (tmp_path / "snapshot_x.jsonl").write_text(body)
    leaves = snapshot.read_roots_jsonl(spark, str(tmp_path)).where("snapshotFile = 'snapshot_1_5.jsonl.gz'")
    assert [(r["blockNumber"], r["root"]) for r in leaves.orderBy("blockNumber").collect()] == [(1, "aa"), (2, "bb")]
    computed = verify.roots(leaves).first()
    sig = lambda root, f, kind: (f, root, 1, 5, kind)
    rows = [sig(computed["computed"].upper(), "snapshot_1_5.jsonl.gz", "Ed25519"), sig("00", "none", "ES256K")]
    rep = {r["snapshotFile"]: r for r in verify.report(spark.createDataFrame(rows, "snapshotFile string, merkleRoot string, startBlock long, endBlock long, signatureType string"), leaves).collect()}
    assert rep["snapshot_1_5.jsonl.gz"]["valid"] and not rep["none"]["valid"] and rep["none"]["n_roots"] == 0
    assert [r["start"] for r in snapshot.catalog(spark, str(tmp_path)).collect()] == [1]


def test_retention(spark):
    b = spark.createDataFrame([(n,) for n in (1, 2, 3, 5, 6)], "number long")
    assert retention.by_range(b, 4).first()["cutoff"] == 2 and retention.by_range(b, 6).first()["cutoff"] is None
    assert sorted(r[0] for r in retention.by_count(b, 3).collect()) == [1, 2] and retention.by_count(b, 9).count() == 0 and retention.by_count(b, 0).count() == 5
    c = spark.createDataFrame([(n, 5) for n in (1, 2, 3, 5, 6)], "blockNumber long, docs long")
    drained = lambda x: sorted(r[0] for r in retention.by_doc_budget(c, x, 2).collect())
    assert (drained(3), drained(0), drained(11), drained(999)) == ([1], [], [1, 2, 3], [1, 2, 3, 5, 6])
    t = spark.createDataFrame([("1",), ("5",), ("10",), (None,), ("x",)], "n string")
    assert [r[0] for r in retention.select_oldest(t, "n", 3).collect()] == ["1"] and retention.select_oldest(t, "n", 0).count() == 0
    with pytest.raises(ValueError):
        retention.select_oldest(t.where("n = 'x'"), "n", 3)
    assert retention.block_range(b.where("number > 99")).first()["status"] == "no blocks"
    order = []
    failing = {"Log": True}

    def put(name, df):
        order.append((name, df.count()))
        if failing.get(name):
            raise OSError("disk")

    docs = b.select(F.col("number").alias("blockNumber"))
    errors = retention.apply({"Block": b, "Log": docs, "Transaction": docs}, retention.by_count(b, 3), put)
    assert [x[0] for x in order] == ["Log", "Transaction", "Block"] and order[-1][1] == 3 and errors == ["Log: disk"]
    assert retention.run(b, 4).count() == 2 and retention.run(b, 4, b).count() == 1


def test_reads(spark):
    b = spark.createDataFrame([(1, "x"), (2, "y")], "number long, hash string")
    with pytest.raises(ValueError):
        query.order_limit(b, limit=1)
    assert query.where(b, query.condition("number", "geq", 2), query.condition("number", "leq", 2)).count() == 1
    assert query.where_in(b, "number", range(2, 3000)).count() == 1 and query.where_in(b, "number", b.where("number=1").select("number")).count() == 1
    t = spark.createDataFrame([(1, "t1")], "blockNumber long, hash string")
    got = {r["number"]: r["txs"] for r in query.nest_many(b, t, "number", "blockNumber", "txs", ["hash"]).collect()}
    assert got[2] == [] and got[1][0]["hash"] == "t1"


def test_attestation(spark):
    d = spark.createDataFrame([(1, "a", bytearray(b"a")), (1, "b", None), (2, "c", None), (3, "d", bytearray(b"d"))], "blockNumber long, doc_id string, cid binary")
    assert {r["blockNumber"]: r["status"] for r in attest.coverage(d).collect()} == {1: "incomplete", 2: "no CIDs", 3: "ok"}
    e = spark.createDataFrame([(1, 2), (2, 5), (9, 1)], "number long, expected_docs long")
    assert {r["number"]: r["attestable"] for r in attest.completeness(e, d).collect()} == {1: True, 2: False, 9: False}


def test_freshness_and_heights(spark):
    rows = [("a", "2024-01-01 00:00:00", True), ("b", "2024-01-01 00:06:00", True), ("c", "2024-01-01 00:00:00", False)]
    h = spark.createDataFrame(rows, "chain string, processed_at string, success boolean")
    got = {r["chain"]: (r["healthy"], r["ready"]) for r in ops.freshness(h, F.lit("2024-01-01 00:10:00").cast("timestamp")).collect()}
    assert got == {"a": (True, False), "b": (True, True), "c": (True, True)}
    b = spark.createDataFrame([(n,) for n in (0, 1, 4, 5, 9)], "number long")
    assert sorted(map(tuple, stream.gaps(b, 3).collect())) == [(2, 3), (6, 8)]
    start = lambda *a: stream.plan_start(*a).first()[0]
    assert (start(b, 50), start(b, 500), start(b.where("number > 99"), 500, 7), start(b.where("number > 99"), 50)) == (10, 400, 7, 0)
    assert stream.confirmed(b, 4).count() == 4 and stream.confirmed(b.where("number > 99"), 4).count() == 0
    done = []
    with pytest.raises(OSError):
        ops.maintain(lambda: (_ for _ in ()).throw(OSError("x")), lambda: done.append(1))
    assert not done


def test_ingest_is_idempotent(spark, tmp_path):
    b, r, root = tmp_path / "b", tmp_path / "r", str(tmp_path / "t")
    write(r / "1.json", [receipt("0x1", 10, logs=2)])
    write(b / "1.json", [raw_block(10, [raw_tx("0x1"), raw_tx("0x2")])])
    go = lambda: stream.ingest(spark, str(b), str(r), root, "c", str(tmp_path / "cp")).awaitTermination()
    go()
    write(b / "2.json", [raw_block(10, [raw_tx("0x9")], hash="0xother"), raw_block(11, [raw_tx("0x5")])])
    go()
    count = lambda t: tables.scan(spark, root, t, "c").count()
    assert (count("Block"), count("Transaction"), count("Log"), count("AccessListEntry")) == (2, 3, 2, 3)
    t = {x["hash"]: x for x in tables.scan(spark, root, "Transaction", "c").collect()}
    assert t["0x1"]["status"] is True and t["0x1"]["gasUsed"] == "21" and t["0x1"]["block_id"]


def test_ingest_receipts_and_attestations(spark, tmp_path):
    b, r, one, root = tmp_path / "b", tmp_path / "r", tmp_path / "one", str(tmp_path / "t")
    write(r / "1.json", [receipt("0x1", 10, gasUsed="0x5", blockNumber="0xa"), receipt("0x1", 10, logs=2, gasUsed="0x7", blockNumber="0xa")])
    write(one / "1.json", [receipt("0x1", 10, gasUsed="0x9"), receipt("0x2", 10, first=2, gasUsed="0x3", blockNumber="0xa")])
    write(b / "1.json", [raw_block(10, [raw_tx("0x1"), raw_tx("0x2")])])
    go = lambda **k: stream.ingest(spark, str(b), str(r), root, "c", str(tmp_path / "cp"), single_receipts_dir=str(one), **k)
    go().awaitTermination()
    tx = {x["hash"]: x["gasUsed"] for x in tables.scan(spark, root, "Transaction", "c").collect()}
    assert tx == {"0x1": "0x7", "0x2": "0x3"} and tables.scan(spark, root, "Log", "c").count() == 3
    sig = tables.scan(spark, root, "BlockSignature", "c").collect()
    docs = sum(tables.scan(spark, root, t, "c").count() for t in ("Block", "Transaction", "Log", "AccessListEntry"))
    assert [(x["blockNumber"], x["cidCount"], len(x["merkleRoot"])) for x in sig] == [(10, docs, 64)]
    # a replay of a stored block without an attestation makes one, and changes nothing else
    import shutil

    shutil.rmtree(f"{root}/BlockSignature")
    write(b / "2.json", [raw_block(10, [raw_tx("0x9")], hash="0xother")])
    q = go(per_minute=100)
    q.processAllAvailable()
    q.stop()
    again = tables.scan(spark, root, "BlockSignature", "c").collect()
    assert [x["merkleRoot"] for x in again] == [sig[0]["merkleRoot"]] and tables.scan(spark, root, "Transaction", "c").count() == 2


def test_pruned_tables(spark, tmp_path):
    root = str(tmp_path)
    for n in (5, 990, 1500, 1999, 2001, 3500):
        tables.add(spark, root, "Block", "c", [{"number": n, "hash": str(n)}])
    tables.add(spark, root, "Log", "c", [{"blockNumber": n, "blockHash": str(n), "logIndex": 0} for n in (5, 1500, 1600)])
    left = lambda of, h: sorted(r[h] for r in tables.scan(spark, root, of, "c").collect())
    cutoff = retention.by_range(tables.scan(spark, root, "Block", "c"), 2001).first()["cutoff"]
    assert cutoff == 1499
    got = {r["collection"]: r["rows"] for r in retention.prune(spark, root, "c", cutoff).collect()}
    assert got["Block"] == 2 and got["Log"] == 1 and left("Block", "number") == [1500, 1999, 2001, 3500] and left("Log", "blockNumber") == [1500, 1600]
    retention.prune(spark, root, "c", 1999)
    assert left("Block", "number") == [2001, 3500] and left("Log", "blockNumber") == [] and retention.prune(spark, root, "c", None).count() == 0


def test_head_offset_widens(spark):
    b = spark.createDataFrame([(n, n % 100 != 0) for n in range(0, 1001)], "number long, plain boolean")
    top = lambda *a: stream.confirmed(b, *a).agg(F.max("number")).first()[0]
    assert top(100) == 900 and top(100, F.lit(True)) == 900 and top(100, F.col("number") <= 850) == 800 and top(100, F.col("number") == 200) == 200 and top(100, F.col("plain")) is None


def test_in_order_release(spark, tmp_path):
    src, out = tmp_path / "src", []
    for i, rows in enumerate(([(10, True), (12, True), (13, False)], [(11, True), (15, True)], [(14, True)])):
        write(src / f"{i}.json", [{"chain": "c", "number": n, "ok": ok} for n, ok in rows])
        os.utime(src / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # files come in order of their times
    df = spark.readStream.schema("chain string, number long, ok boolean").option("maxFilesPerTrigger", 1).json(str(src))
    q = stream.in_order(df, 10).writeStream.outputMode("append").foreachBatch(lambda d, i: out.append(sorted(r["number"] for r in d.collect()))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [x for x in out if x] == [[10], [11, 12, 13], [14, 15]]
