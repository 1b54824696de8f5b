import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ops, retention
from ledgerloom.sources import tables
from ledgerloom.streaming import stream

from test_ingest import Chain, chain_of, small  # noqa: F401 - a fixture for all tests here
from test_tables import write


def drain(df, path, name):
    """Runs a stream over what is there; returns all rows it has given out so far."""
    df.writeStream.format("parquet").option("path", str(path / name)).option("checkpointLocation", str(path / f"{name}-cp")).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(str(path / name)).collect()


def test_a_million_heights_in_random_order(spark, tmp_path):
    n, r = 1_000_000, random.Random(2)
    heights = spark.range(n).select(F.lit("c").alias("chain"), (F.col("id") + 7).alias("number"), (F.col("id") % 10 != 0).alias("ok"))
    heights.withColumn("lot", F.pmod(F.xxhash64("number"), F.lit(4))).write.partitionBy("lot").parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("chain string, number long, ok boolean, lot int").option("maxFilesPerTrigger", 6).parquet(str(tmp_path / "in"))
    out, touched = [], []

    def put(d, i):
        rows = d.agg(F.min("number"), F.max("number"), F.count("*"), F.count_if(~F.col("ok"))).first()
        if rows[2]:
            out.append(tuple(rows))

    q = stream.in_order(src, 7).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    touched = [sum(s["numRowsUpdated"] for s in p["stateOperators"]) for p in q.recentProgress]
    assert sum(x[2] for x in out) == n and sum(x[3] for x in out) == n // 10
    at = 7
    for low, high, count, _ in out:
        assert low == at and high - low + 1 == count
        at = high + 1
    assert max(touched) <= 3 * (n // stream.SPAN + 2)  # a few rows for each thousand heights


def test_release_with_several_chains_and_restarts(spark, tmp_path):
    r, got = random.Random(1), []
    rows = [{"chain": c, "number": n, "ok": n % 3 > 0} for c, last in (("a", 2600), ("b", 400)) for n in range(5, last)]
    r.shuffle(rows)
    for i in range(4):
        write(tmp_path / f"in/{i}.json", rows[i::4])
        os.utime(tmp_path / f"in/{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
        src = spark.readStream.schema("chain string, number long, ok boolean").json(str(tmp_path / "in"))
        got = drain(stream.in_order(src, 5), tmp_path, "out")
        for c in "ab":  # all below the first that is missing, and no more
            have = {x["number"] for k in range(i + 1) for x in rows[k::4] if x["chain"] == c}
            frontier = next(n for n in range(5, 10_000) if n not in have)
            assert sorted(x.number for x in got if x.chain == c) == list(range(5, frontier))
    assert {(x.chain, x.number, x.ok) for x in got} == {(x["chain"], x["number"], x["ok"]) for x in rows} and len(got) == len(rows)


def test_subscriber_sees_each_row_of_its_chain_once(spark, tmp_path):
    c, other = Chain(spark, tmp_path / "x"), Chain(spark, tmp_path / "y", "other")
    other.root = c.root
    c.land(*chain_of(4, first=998)).go()
    other.land(*chain_of(3, first=7)).go()
    sub = lambda: stream.subscribe(spark, c.root, "Block", "c")
    see = lambda: sorted(r["number"] for r in drain(sub(), tmp_path, "out"))
    assert see() == [998, 999, 1000, 1001]
    retention.prune(spark, c.root, "c", 998)
    assert see() == [998, 999, 1000, 1001]
    c.land(*chain_of(2, first=1002)).go()
    # files of a bucket are written again, as a job that joins small ones would
    bucket = tables.read(spark, f"{c.root}/Block", tables.stored_schema("Block")).where("chain = 'c' and block_bucket = 1")
    bucket.write.parquet(str(tmp_path / "copy"))
    again = spark.read.schema(tables.stored_schema("Block")).parquet(str(tmp_path / "copy"))
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chain", "block_bucket").parquet(f"{c.root}/Block")
    assert see() == [998, 999, 1000, 1001, 1002, 1003]
    c.land(*chain_of(1, first=1004)).go()
    assert see() == [998, 999, 1000, 1001, 1002, 1003, 1004]
    some = drain(stream.subscribe(spark, c.root, "Log", "c", F.col("blockNumber") == 1003), tmp_path, "logs")
    assert len(some) == 6 and "chain" not in some[0].asDict()
    c.land(["{bad"]).go()
    assert [r["raw"] for r in drain(stream.subscribe_rejects(spark, c.root, "c"), tmp_path, "bad")] == ["{bad"]


def test_intervals_after_each_batch(spark, tmp_path):
    from ledgerloom.operators import intervals

    r, have, root = random.Random(8), set(), str(tmp_path)
    for i in range(10):
        base = r.choice([0, 900, 5000, 1_000_000])
        batch = {base + r.randrange(300) for _ in range(r.randrange(1, 120))}
        have |= batch
        intervals.add(spark.createDataFrame([(n,) for n in batch], "number long"), root, "c", f"p-{i}")
        want = sorted(map(tuple, stream.gaps(spark.createDataFrame([(n,) for n in have], "number long"), 500).collect()))
        assert sorted(map(tuple, intervals.gaps(spark, root, "c").collect())) == want
    rows = spark.read.parquet(f"{root}/Heights/chain=c/part=p-9").count()
    assert rows == len({n // 1000 for n in batch})  # the buckets of the batch only
    tables.raise_floor(spark, root, "c", 5100)
    want = sorted(map(tuple, stream.gaps(spark.createDataFrame([(n,) for n in have if n >= 5100], "number long"), 500).collect()))
    got = sorted(map(tuple, intervals.gaps(spark, root, "c").collect()))
    assert [g for g in got if g[1] >= min(n for n in have if n >= 5100)] == want


def test_roots_that_grow(spark, tmp_path):
    import hashlib

    from ledgerloom.operators import snapshot

    def fold(leaves):
        nodes = [hashlib.sha256(x).digest() for x in leaves]
        while len(nodes) > 1:
            nodes = [hashlib.sha256(b"".join(nodes[i : i + 2])).digest() if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0].hex()

    r, n, part = random.Random(3), 0, 0
    leaf = lambda i: hashlib.sha256(str(i).encode()).digest()
    while n < 300:
        more = r.choice([1, 1, 2, 3, 40, 64])
        rows = [(i, leaf(i).hex()) for i in range(n, n + more)] + [(n + more - 1, "zz")]
        n += more
        got = snapshot.grow_roots(spark, str(tmp_path), "c", spark.createDataFrame(rows, "blockNumber long, merkleRoot string"), F.lit(0), part).first()
        assert (got["n"], got["root"]) == (n, fold([leaf(i) for i in range(n)]))
        part += 1
    again = snapshot.grow_roots(spark, str(tmp_path), "c", spark.createDataFrame(rows, "blockNumber long, merkleRoot string"), F.lit(0), part - 1).first()
    assert again["root"] == got["root"]  # a part that is repeated, and heights that are there already
    assert not snapshot.grow_roots(spark, str(tmp_path), "c", spark.createDataFrame(rows, "blockNumber long, merkleRoot string"), F.lit(0), part).count()


def test_run_log_agrees_with_the_tables(spark, tmp_path):
    import time

    from ledgerloom.operators import snapshot

    c = Chain(spark, tmp_path / "x")
    c.land(*chain_of(30, txs=1, first=20)).go()
    docs = lambda: sum(c.table(t).count() for t in ("Block", "Transaction", "Log", "AccessListEntry"))
    log = lambda root: {r["job"]: r for r in ops.metrics(ops.run_log(spark, root, "c")).collect()}
    m = log(c.root)["ingest"]
    assert (m["blocks"], m["docs"], m["last_block"]) == (30, docs(), 49)
    out = str(tmp_path / "out")
    snapshot.export({t: c.table(t) for t in ("Block", "Log")}, snapshot.plan(c.table("Block"), 10), out, chain="c")
    assert log(out)["export"]["blocks"] == 30 and log(out)["export"]["docs"] == 30 + c.table("Log").count()
    before = docs() + c.table("BlockSignature").count()
    retention.prune(spark, c.root, "c", 29)
    assert log(c.root)["prune"]["blocks"] == 10 and log(c.root)["prune"]["docs"] == before - docs() - c.table("BlockSignature").count()
    listener = ops.RunListener(spark, c.root, "c")
    spark.streams.addListener(listener)
    try:
        stream.subscribe(spark, c.root, "Block", "c").writeStream.queryName("watch").format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if "query-watch" in log(c.root):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert ops.run_log(spark, c.root, "c").where("job = 'query-watch'").agg(F.sum("rows")).first()[0] == 30  # as read, those below the floor among them
