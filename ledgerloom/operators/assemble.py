"""Linking of transactions, receipts, logs and access lists, and what a block should hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fields by which a child names its transaction
OF_TX = ("transactionHash", "hash")


def last_receipts(receipts: DataFrame, order: str | None = None) -> DataFrame:
    """One receipt a transaction: of several the last by `order`."""
    if order is None:
        return receipts.dropDuplicates(["transactionHash"])
    cols = [c for c in receipts.columns if c != order]
    best = receipts.groupBy("transactionHash").agg(F.max_by(F.struct(*cols), F.col(order)).alias("r"))
    return best.select("r.*")


def tx_receipts(transactions: DataFrame, receipts: DataFrame, order: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Transactions with status, gasUsed and cumulativeGasUsed of their receipt, and others to keep; has_receipt is false where none is."""
    r = last_receipts(receipts, order)
    fields = [c for c in ("status", "gasUsed", "cumulativeGasUsed", *keep) if c in r.columns]
    r = r.select(F.col("transactionHash").alias("_hash"), *(F.col(c).alias(f"_r_{c}") for c in fields))
    out = transactions.join(r, F.col("hash") == F.col("_hash"), "left").withColumn("has_receipt", F.col("_hash").isNotNull())
    for c in fields:
        value = F.col(f"_r_{c}") == "1" if c == "status" else F.col(f"_r_{c}")
        out = out.withColumn(c, F.coalesce(value, F.col(c)) if c in transactions.columns else value)
    return out.drop("_hash", *(f"_r_{c}" for c in fields))


def linked(children: DataFrame, transactions: DataFrame, on: tuple[str, str] = OF_TX) -> DataFrame:
    """Logs or access-list entries of transactions that are there."""
    return children.join(transactions.select(F.col(on[1]).alias(on[0])), on[0], "left_semi")


def skipped(children: DataFrame, transactions: DataFrame, on: tuple[str, str] = OF_TX) -> DataFrame:
    return children.join(transactions.select(F.col(on[1]).alias(on[0])), on[0], "left_anti")


def new_blocks(blocks: DataFrame, stored: DataFrame) -> DataFrame:
    """Blocks at heights not stored yet; the first write of a height wins."""
    return blocks.join(stored.select("number"), "number", "left_anti")


def expected_docs(blocks: DataFrame, transactions: DataFrame, logs: DataFrame, access_list: DataFrame) -> DataFrame:
    """number, txs, logs, entries, expected_docs: a block counts 1, and all that hangs on it.

    logs should be those of transactions with a receipt.
    """
    parts = [d.select(F.col("blockNumber").alias("number"), F.lit(i).alias("k")) for i, d in enumerate((transactions, logs, access_list))]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("number").agg(*(F.sum((F.col("k") == i).cast("long")).alias(n) for i, n in enumerate(("txs", "logs", "entries"))))
    out = blocks.select("number").join(counts, "number", "left").na.fill(0, ["txs", "logs", "entries"])
    return out.withColumn("expected_docs", F.col("txs") + F.col("logs") + F.col("entries") + 1)


def block_stats(linked_transactions: DataFrame, expected: DataFrame, threshold: int = 1000) -> DataFrame:
    """number, txs, missing_receipts, expected_docs, size_class."""
    missing = linked_transactions.groupBy(F.col("blockNumber").alias("number")).agg(F.sum((~F.col("has_receipt")).cast("long")).alias("missing_receipts"))
    out = expected.join(missing, "number", "left").na.fill(0, ["missing_receipts"])
    return out.select("number", "txs", "missing_receipts", "expected_docs", F.when(F.col("expected_docs") <= threshold, "single").otherwise("batched").alias("size_class"))
