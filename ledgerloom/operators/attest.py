"""Completeness of blocks and attestation of their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.merkle import byte_bucket, root, roots


def documents(blocks: DataFrame, *children: DataFrame) -> DataFrame:
    """(blockNumber, doc_id, cid) over all collections."""
    out = blocks.select(F.col("number").alias("blockNumber"), "doc_id", "cid")
    for c in children:
        out = out.unionByName(c.select("blockNumber", "doc_id", "cid"))
    return out


def completeness(expected: DataFrame, docs: DataFrame) -> DataFrame:
    """number, expected_docs, written, attestable."""
    written = docs.groupBy(F.col("blockNumber").alias("number")).agg(F.count("*").alias("written"))
    out = expected.select("number", "expected_docs").join(written, "number", "left").na.fill(0, ["written"])
    return out.withColumn("attestable", F.col("written") == F.col("expected_docs"))


def coverage(docs: DataFrame) -> DataFrame:
    """blockNumber, docs, cids, status: ok, no CIDs or incomplete."""
    out = docs.groupBy("blockNumber").agg(F.count("*").alias("docs"), F.count("cid").alias("cids"))
    return out.withColumn("status", F.when(F.col("cids") == 0, "no CIDs").when(F.col("cids") < F.col("docs"), "incomplete").otherwise("ok"))


def block_doc_ids(docs: DataFrame) -> DataFrame:
    return docs.groupBy("blockNumber").agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"))


def collect_cids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Content ids of the documents named by ids.doc_id."""
    return docs.join(ids.select("doc_id"), "doc_id", "left_semi").select("doc_id", "cid")


def block_roots(docs: DataFrame, chunked: bool = False) -> DataFrame:
    """blockNumber, n_leaves, root over content ids in byte order; chunked for blocks of more than about 65,000 documents."""
    docs = docs.where("cid is not null")
    if chunked:
        return roots(docs, ["blockNumber"], "cid", "cid", byte_bucket(F.col("cid")))
    leaves = F.array_sort(F.collect_list("cid"))
    return docs.groupBy("blockNumber").agg(F.count("*").alias("n_leaves"), root(leaves).alias("root"))


def block_records(docs: DataFrame, blocks: DataFrame, created_at: Column | str, signatures: DataFrame | None = None) -> DataFrame:
    """One attestation a block; type, identity and value come from `signatures` (blockNumber, ...) or stay NULL."""
    out = docs.where("cid is not null").groupBy("blockNumber").agg(F.array_sort(F.collect_list("cid")).alias("leaves"), F.count("*").alias("cidCount"))
    # hex digits keep the order of the bytes
    out = out.select("blockNumber", F.lower(F.hex(root(F.col("leaves")))).alias("merkleRoot"), "cidCount", F.transform("leaves", lambda c: F.lower(F.hex(c))).alias("cids"))
    out = out.join(blocks.select(F.col("number").alias("blockNumber"), F.col("hash").alias("blockHash")), "blockNumber")
    names = ["signatureType", "signatureIdentity", "signatureValue"]
    out = out.join(signatures.select("blockNumber", *names), "blockNumber", "left") if signatures is not None else out.withColumns({n: F.lit(None).cast("string") for n in names})
    return out.withColumn("createdAt", F.lit(created_at) if isinstance(created_at, str) else created_at)


def backfill(blocks: DataFrame, block_signatures: DataFrame) -> DataFrame:
    """Stored blocks that have no attestation yet."""
    return blocks.join(block_signatures.select(F.col("blockNumber").alias("number")), "number", "left_anti")
