"""Raw blocks and receipts to the tables' columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..sources.schema import BLOCK


def _text(*names: str) -> list[Column]:
    return [X.blank(F.col(n)).alias(n) for n in names]


def blocks(raw: DataFrame) -> DataFrame:
    """One row a raw block; a malformed number gives a NULL number, which quality.split rejects."""
    fields = [f for f in BLOCK.fieldNames() if f not in ("number", "uncles", "totalDifficulty", "logsBloom", "extraData")]
    return raw.where("hash is not null or number is not null").select(
        X.to_int(F.col("number")).alias("number"),
        *_text(*fields),
        F.lit("").alias("totalDifficulty"),
        X.strip_hex(X.blank(F.col("logsBloom"))).alias("logsBloom"),
        X.strip_hex(X.blank(F.col("extraData"))).alias("extraData"),
        F.coalesce(F.filter("uncles", lambda x: x.isNotNull()), F.array().cast("array<string>")).alias("uncles"),
    )


def _transactions(raw: DataFrame) -> DataFrame:
    """One row for each transaction, null ones left out; its index is its place in the block."""
    rows = raw.select(F.col("hash").alias("_block"), X.to_int(F.col("number")).alias("_number"), F.posexplode("transactions").alias("_pos", "_t"))
    return rows.where("_t is not null").select("_block", "_number", "_pos", "_t.*")


def transactions(raw: DataFrame, entries: bool = False) -> DataFrame:
    """One row a raw transaction. entries: with what access_list() makes of it, as an array."""
    t = _transactions(raw)
    own = F.transform(F.filter("accessList", lambda e: e.isNotNull()), lambda e: F.struct(F.col("_number").alias("blockNumber"), *_entry(e)))
    kind = X.blank(F.col("type"))
    return t.select(
        F.col("hash"), F.col("_block").alias("blockHash"), F.coalesce(X.to_int(F.col("blockNumber")), F.col("_number")).alias("blockNumber"),
        X.sender(F.col("from")).alias("from"), *_text("to", "value", "gas"),
        X.blank(X.gas_price(kind, F.col("gasPrice"), F.col("maxFeePerGas"))).alias("gasPrice"),
        X.fee_field(kind, F.col("maxFeePerGas")).alias("maxFeePerGas"), X.fee_field(kind, F.col("maxPriorityFeePerGas")).alias("maxPriorityFeePerGas"),
        X.normalize_hex(X.blank(F.col("input"))).alias("input"), *_text("nonce"), F.col("_pos").cast("long").alias("transactionIndex"), kind.alias("type"), *_text("chainId", "v", "r", "s"),
        F.lit(True).alias("status"), *_text("gasUsed", "cumulativeGasUsed", "effectiveGasPrice"),
        *((own.alias("entries"),) if entries else ()),
    )


def receipts(raw: DataFrame) -> DataFrame:
    """One row a raw receipt; `place`, its place among all, stays where the rows have it."""
    place = [c for c in raw.columns if c == "place"]
    ok = F.coalesce(X.to_int(F.col("status")), F.lit(0)) == 1
    return raw.where("transactionHash is not null").select("transactionHash", X.to_int(F.col("transactionIndex")).alias("transactionIndex"), *_text("blockHash"), X.to_int(F.col("blockNumber")).alias("blockNumber"), *_text("from", "to", "cumulativeGasUsed", "gasUsed"), X.contract_address(F.col("contractAddress")).alias("contractAddress"), F.when(ok, "1").otherwise("0").alias("status"), "logs", *place)


def logs(receipt_rows: DataFrame, *keep: str) -> DataFrame:
    """One row a log; columns of the receipts to keep must not be named as a log's."""
    rows = receipt_rows.select(*keep, F.explode("logs").alias("_l")).where("_l is not null").select(*keep, "_l.*")
    return rows.select(*keep, *_text("address"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"), X.strip_hex(X.blank(F.col("data"))).alias("data"), "transactionHash", *_text("blockHash"), X.to_int(F.col("blockNumber")).alias("blockNumber"), "transactionIndex", "logIndex", F.coalesce(F.col("removed"), F.lit(False)).cast("string").alias("removed"))


def access_list(raw: DataFrame) -> DataFrame:
    rows = _transactions(raw).select(F.col("hash").alias("transactionHash"), F.col("_number").alias("blockNumber"), F.explode("accessList").alias("_e")).where("_e is not null")
    return rows.select("transactionHash", "blockNumber", *_entry(F.col("_e")))


def _entry(e: Column) -> list[Column]:
    return [X.blank(e["address"]).alias("address"), F.coalesce(e["storageKeys"], F.array().cast("array<string>")).alias("storageKeys")]
