import pytest

from ledgerloom.plans.registry import ORACLES, QUERIES

from oracle import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf, name):
    compare(spark, sf, QUERIES[name], ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and "root" in df.columns
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())


def test_point_filters_reach_the_scan(spark, tmp_path):
    from ledgerloom.sources import tables

    tables.add(spark, str(tmp_path), "Block", "c", [{"number": n, "hash": str(n)} for n in (5, 1500)])
    plan = tables.scan(spark, str(tmp_path), "Block", "c", (1500, 1500)).select("hash")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "block_bucket" in plan and "GreaterThanOrEqual(number,1500)" in plan


def test_views_write_nothing(spark, sf):
    """A view is worked out where it is read: only the columns of a query move, and no copy of the view is made for it."""
    from ledgerloom.plans.chainview import ChainView
    from ledgerloom.sources import tables

    v = ChainView(spark, sf)
    for view in (v.blocks, v.transactions, v.receipts, v.logs, v.access_list):
        view()
    where, fs = tables.file_system(spark, tables.shared_folder(spark, "x").rsplit("/", 1)[0])
    assert not fs.exists(where) or not [s for s in fs.listStatus(where) if s.getPath().getName().startswith("view-")]
    plan = v.transactions()._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan.split("Exchange")[0] and "sha2" not in plan.split("Exchange", 1)[1]  # texts are made after the shuffle


def test_places_of_lines_that_are_there_twice(spark, tmp_path):
    """Equal lines, orders of one key on one day and on two days: as SQL numbers them."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE o AS SELECT * FROM (VALUES (1, 7, 'O', 3), (1, 7, 'O', 3), (1, 7, 'F', 4), (2, 8, 'P', 3), (3, 8, 'O', 4), (9, 9, 'O', 5)) t(k, c, s, d)")
    con.execute(f"COPY (SELECT k::BIGINT o_orderkey, c::BIGINT o_custkey, s o_orderstatus, TIMESTAMP '1995-01-01' + d * INTERVAL 1 DAY o_orderdate FROM o) TO '{tmp_path}/orders.parquet'")
    line = "k::BIGINT l_orderkey, p::BIGINT l_partkey, 5::BIGINT l_suppkey, n::INT l_linenumber, 1.5 l_quantity, 2.5 l_extendedprice, 0.0 l_discount, 0.0 l_tax, 'A' l_returnflag, 'F' l_linestatus, TIMESTAMP '1995-02-01' l_shipdate"
    con.execute(f"COPY (SELECT {line} FROM (VALUES (1, 4, 1), (1, 4, 1), (1, 2, 3), (2, 4, 2), (2, 1, 1), (3, 4, 1), (4, 4, 1)) t(k, p, n)) TO '{tmp_path}/lineitem.parquet'")
    for t in ("region", "nation", "customer", "supplier", "part", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"COPY (SELECT 1 AS x) TO '{tmp_path}/{t}.parquet'")
    for name in ("logs_linked", "access_list_linked", "doc_id_pack", "block_merkle_root_chunked"):
        compare(spark, str(tmp_path), QUERIES[name], ORACLES[name])


def test_landed_data_is_kept_small(spark, sf):
    """Landing files are packed, and tables and staged rows too."""
    from ledgerloom.plans import landed
    from ledgerloom.plans.chainview import ChainView
    from ledgerloom.sources import tables

    base = landed.root(ChainView(spark, sf)).rsplit("/", 1)[0]
    for folder, ending in (("receipts", ".json.gz"), ("blocks", ".json.gz"), ("tables/Log", ".zstd.parquet"), ("checkpoint-staged/receipts", ".zstd.parquet")):
        where, fs = tables.file_system(spark, f"{base}/{folder}")
        files, names = fs.listFiles(where, True), []
        while files.hasNext():
            s = files.next()
            names += [s.getPath().getName()] if s.getLen() and "stage=-1" not in s.getPath().toString() else []
        parts = [n for n in names if n.startswith("part-")]
        assert parts and all(n.endswith(ending) for n in parts)


def test_texts_do_not_move_to_meet(spark, sf):
    """Where no side fits a broadcast, lines stay where they lie by their order, and ids of a block need no ranking of its lines."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = {n: QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString() for n in ("q_logs_nested", "q_transactions_nested", "q_transactions_for_address", "q_transactions_with_topic", "access_list_linked", "block_doc_ids", "verify_report")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for n in ("q_logs_nested", "q_transactions_nested", "q_transactions_for_address", "q_transactions_with_topic"):
        assert "hashpartitioning(transactionHash" not in plan[n]
    assert plan["access_list_linked"].count("hashpartitioning(transactionHash") == 1  # of receipts
    assert "l_quantity" not in plan["block_doc_ids"] + plan["verify_report"]


def test_ids_of_lines_follow_from_their_number(spark, sf, monkeypatch):
    from ledgerloom.plans import chainview

    monkeypatch.setattr(chainview, "LOT", 3)
    v = chainview.ChainView(spark, sf)
    for whole, ids in ((v.logs(), v.log_ids()), (v.access_list(), v.entry_ids())):
        rows = [sorted(map(tuple, df.select("blockNumber", "doc_id", "cid").collect())) for df in (whole, ids)]
        assert rows[0] == rows[1] and len(rows[0]) > 1000


def test_landing_lines_are_made_where_lines_lie(spark, sf, tmp_path):
    """Receipts take their logs, and transactions their entries, by order; a row without ids has those of its content when it is stored."""
    from ledgerloom.plans import landed
    from ledgerloom.plans.chainview import ChainView
    from ledgerloom.sources import tables

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = ChainView(spark, sf)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (landed.raw_receipts(v), landed.raw_blocks(v))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not any("hashpartitioning(transactionHash" in p or "hashpartitioning(hash" in p for p in plans)
    row = spark.createDataFrame([{f.name: None for f in tables.TABLES["Log"].fields} | {"blockHash": "0x1", "logIndex": 1, "blockNumber": 5}], tables.TABLES["Log"])
    tables.append_new(row, str(tmp_path), "Log", "c", unique=True)
    stored = tables.scan(spark, str(tmp_path), "Log", "c").select("doc_id", "cid").collect()
    assert stored == tables.with_ids(row).select("doc_id", "cid").collect()


def test_landed_texts_move_as_bytes(spark, sf, tmp_path):
    """Rows that are written to a table, to the index or to a landing file have their hex as bytes when they are shuffled."""
    from ledgerloom.plans import landed
    from ledgerloom.plans.chainview import ChainView
    from ledgerloom.sources import index, tables

    v = ChainView(spark, sf)
    logs = v.logs().withColumn("block_bucket", tables.bucket_of("blockNumber"))
    out = tables.clustered(logs, "Log")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("RebalancePartitions", 1)
    assert "unhex" in below[1] and "unhex" not in below[0]
    assert sorted(map(str, out.collect())) == sorted(map(str, logs.collect()))
    assert "unhex" in index.entries(logs, None)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in landed.raw_blocks(v)._jdf.queryExecution().optimizedPlan().toString()


def test_parties_are_counted_as_numbers(spark, sf):
    """Texts of addresses are made after the shuffle, and counts are those of the view's own texts."""
    from pyspark.sql import functions as F

    from ledgerloom.plans.chainview import ChainView

    plan = QUERIES["q_address_activity"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "sha2" not in plan.split("Exchange", 1)[1]
    rows = ChainView(spark, sf).transactions().select(F.explode(F.array_distinct(F.array("from", "to"))).alias("address")).where("address <> ''")
    assert sorted(QUERIES["q_address_activity"](spark, sf).collect()) == sorted(rows.groupBy("address").agg(F.count("*").alias("n")).collect())


def test_copies_of_landed_tables_stay_where_they_lie(spark, sf):
    """A copy has the tables that it is asked for, as files of the source; blocks for landing are made of numbers that moved."""
    from ledgerloom.plans import landed
    from ledgerloom.plans.chainview import ChainView
    from ledgerloom.sources import tables

    v = ChainView(spark, sf)
    assert "sha2" not in v.nested()._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    base = landed.copied(v, "copy", "Transaction")
    where, fs = tables.file_system(spark, base)
    assert [s.getPath().getName() for s in fs.listStatus(where)] == ["Transaction"]
    assert tables.scan(spark, base, "Transaction", landed.CHAIN).exceptAll(landed.table(v, "Transaction")).count() == 0 < landed.table(v, "Transaction").count()


def test_blocks_are_gathered_as_bytes_few_at_a_time(spark, sf):
    """While blocks are gathered their hex is bytes, and a task gathers few of them."""
    from ledgerloom.operators import query
    from ledgerloom.plans.chainview import ChainView

    v = ChainView(spark, sf)
    df = query.block_with_transactions(v.blocks(), v.transactions(), v.logs())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("RepartitionByExpression", 1)[1]
    assert "unhex" in below and below.splitlines()[0].endswith(", 64") and query._parts(v.blocks()) == 64
