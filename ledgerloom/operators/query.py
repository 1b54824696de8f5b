"""Document-style reads over chain tables: filters, order and limit, nesting, and the named queries."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.expr import pack, unpack

#: ids up to which a list becomes a predicate; a longer one becomes a semi join
INLINE_IDS = 1000
LOG_FIELDS = ["logIndex", "address", "topics", "data"]


def condition(field: str, op: str, value) -> Column:
    """eq, in, geq, leq on a field, or any: an array has an element equal to value."""
    c = F.col(field)
    return {"eq": lambda: c == value, "in": lambda: c.isin(list(value)), "geq": lambda: c >= value, "leq": lambda: c <= value, "any": lambda: F.array_contains(c, value)}[op]()


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def where(df: DataFrame, *conditions: Column) -> DataFrame:
    return reduce(lambda d, c: d.where(c), conditions, df)


def where_in(df: DataFrame, field: str, ids: Iterable | DataFrame) -> DataFrame:
    """Rows whose field is among ids; ids may be a one-column DataFrame."""
    if not isinstance(ids, DataFrame):
        ids = list(ids)
        if len(ids) <= INLINE_IDS:
            return df.where(F.col(field).isin(ids))
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], [field])
    return df.join(ids.toDF(field).distinct(), field, "left_semi")


def select(df: DataFrame, *fields: str) -> DataFrame:
    return df.select(*(F.col(f"`{f}`") for f in fields))


def order_limit(df: DataFrame, *order: Column, limit: int | None = None) -> DataFrame:
    """limit needs an order, as without one the rows would be any."""
    if limit is not None and not order:
        raise ValueError("limit needs an order")
    out = df.orderBy(*order)
    return out if limit is None else out.limit(limit)


def nest_many(parents: DataFrame, children: DataFrame, key: str, foreign: str, name: str, fields: list[str]) -> DataFrame:
    """Parents with an array of their children, sorted by the fields in order; empty where there are none."""
    packed = children.groupBy(F.col(foreign).alias("_k")).agg(F.array_sort(F.collect_list(F.struct(*(F.col(f"`{f}`") for f in fields)))).alias(name))
    out = parents.join(packed, parents[key] == F.col("_k"), "left").drop("_k")
    return out.withColumn(name, F.coalesce(F.col(name), F.array().cast(packed.schema[name].dataType)))


def nest_one(children: DataFrame, parents: DataFrame, foreign: str, key: str, name: str, fields: list[str]) -> DataFrame:
    """Children with their parent as a struct, NULL where it is missing."""
    packed = parents.select(F.col(key).alias("_k"), F.struct(*(F.col(f"`{f}`") for f in fields)).alias(name))
    return children.join(packed, children[foreign] == F.col("_k"), "left").drop("_k")


def block_range(df: DataFrame, field: str = "number") -> DataFrame:
    """lowest and highest height, NULL where there are none; height 0 is a height."""
    return df.agg(F.min(field).alias("lowest"), F.max(field).alias("highest"))


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def highest_block(blocks: DataFrame) -> DataFrame:
    return select(order_limit(blocks, F.desc("number"), limit=1), "number")


def latest_blocks(blocks: DataFrame, n: int = 10) -> DataFrame:
    return order_limit(blocks, F.desc("number"), limit=n)


def block_with_transactions(blocks: DataFrame, transactions: DataFrame, logs: DataFrame, number: int | None = None) -> DataFrame:
    """Blocks with their transactions, and these with their logs; the filter reaches all three tables.

    Transactions and logs move once, together, by height: both nestings are then groupings within it. One block's rows are
    one value of the result, so they have to fit a task.
    """
    if number is not None:
        blocks, transactions, logs = blocks.where(F.col("number") == number), transactions.where(F.col("blockNumber") == number), logs.where(F.col("blockNumber") == number)
    log = F.struct(*LOG_FIELDS)
    kind = logs.select(log.alias("l")).schema["l"].dataType
    mine = F.struct("transactionIndex", "hash", "from", "to", "value")
    theirs = transactions.select(mine.alias("t")).schema["t"].dataType
    # hex is bytes while blocks are gathered; texts are made of one block at a time
    tx = transactions.select("blockNumber", pack(F.col("hash"), theirs["hash"].dataType).alias("_h"), pack(mine, theirs).alias("t"))
    own = logs.select("blockNumber", pack(F.col("transactionHash"), theirs["hash"].dataType).alias("_h"), pack(log, kind).alias("l"))
    rows = tx.unionByName(own, allowMissingColumns=True).repartition(_parts(blocks), "blockNumber")
    tx = rows.groupBy("blockNumber", "_h").agg(F.max("t").alias("t"), F.collect_list("l").alias("logs")).where("t is not null")
    packed = tx.groupBy("blockNumber").agg(F.collect_list(F.struct("t", "logs")).alias("transactions"))
    whole = F.transform("transactions", lambda x: F.struct(*(unpack(x["t"][f.name], f.dataType).alias(f.name) for f in theirs.fields), F.array_sort(unpack(x["logs"], ArrayType(kind))).alias("logs")))
    packed = packed.select("blockNumber", F.array_sort(whole).alias("transactions"))
    out = blocks.join(packed, blocks["number"] == packed["blockNumber"], "left").drop("blockNumber")
    return out.withColumn("transactions", F.coalesce("transactions", F.array().cast(packed.schema["transactions"].dataType)))


#: blocks that a task gathers at once, about
AT_ONCE = 8


def _parts(blocks: DataFrame) -> int:
    """Partitions to gather blocks in: a task holds the rows of all its blocks."""
    usual = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(usual, blocks.count() // AT_ONCE), 16 * usual)


def transaction_logs(logs: DataFrame, tx_hash: str) -> DataFrame:
    return where(logs, condition("transactionHash", "eq", tx_hash))


def block_logs(logs: DataFrame, block_hash: str) -> DataFrame:
    return where(logs, condition("blockHash", "eq", block_hash))


def logs_by_topic(logs: DataFrame, topic: str) -> DataFrame:
    return where(logs, condition("topics", "any", topic))


def transaction_by_hash(transactions: DataFrame, logs: DataFrame, tx_hash: str) -> DataFrame:
    return nest_many(where(transactions, condition("hash", "eq", tx_hash)), transaction_logs(logs, tx_hash), "hash", "transactionHash", "logs", LOG_FIELDS)


#: fields by which a log names its transaction
OF_TX = ("transactionHash", "hash")


def transactions_for_address(transactions: DataFrame, logs: DataFrame, address: str, on: tuple[str, str] = OF_TX) -> DataFrame:
    """Sent or received by the address, exact case; logs are joined to those few transactions only."""
    tx = where(transactions, any_of(condition("from", "eq", address), condition("to", "eq", address)))
    own = logs.join(tx.select(F.col(on[1]).alias(on[0])), on[0], "left_semi")
    return nest_many(tx, own, on[1], on[0], "logs", LOG_FIELDS)


def transactions_with_topic(logs: DataFrame, transactions: DataFrame, topic: str, on: tuple[str, str] = OF_TX) -> DataFrame:
    """A row for each log with the topic, with its transaction; a transaction may occur several times."""
    return nest_one(logs_by_topic(logs, topic), transactions, *on, "transaction", ["hash", "from", "to", "value"])


def access_list_by_hash(transactions: DataFrame, entries: DataFrame, tx_hash: str) -> DataFrame:
    own = entries.where(F.col("transactionHash") == tx_hash)
    return nest_many(transactions.where(F.col("hash") == tx_hash), own, "hash", "transactionHash", "accessList", ["address", "storageKeys"])
