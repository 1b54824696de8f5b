"""Declared schemas of tables and landing files; never inferred, only added to."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType


def _struct(text: str = "", longs: str = "", lists: str = "", flags: str = "") -> StructType:
    kinds = ((text, StringType()), (longs, LongType()), (lists, ArrayType(StringType())), (flags, BooleanType()))
    return StructType([StructField(n, k) for names, k in kinds for n in names.split()])


# Columns of each collection.
BLOCK = _struct("hash timestamp parentHash difficulty totalDifficulty gasUsed gasLimit baseFeePerGas nonce miner size stateRoot sha3Uncles transactionsRoot receiptsRoot logsBloom extraData mixHash", "number", "uncles")
TRANSACTION = _struct("block_id hash blockHash from to value gas gasPrice gasUsed maxFeePerGas maxPriorityFeePerGas input nonce type chainId v r s cumulativeGasUsed effectiveGasPrice", "blockNumber transactionIndex", "", "status")
LOG = _struct("block_id transaction_id address data transactionHash blockHash removed", "blockNumber transactionIndex logIndex", "topics")
ACCESS_LIST_ENTRY = _struct("transaction_id address", "blockNumber", "storageKeys")
BLOCK_SIGNATURE = _struct("blockHash merkleRoot signatureType signatureIdentity signatureValue createdAt", "blockNumber cidCount", "cids")
EXPECTED = _struct("", "number txs logs entries missing_receipts expected_docs")
SNAPSHOT_SIGNATURE = _struct("merkleRoot signatureType signatureIdentity signatureValue snapshotFile createdAt", "startBlock endBlock blockCount", "blockSigMerkleRoots")
#: write order: a block first, what depends on it later
TABLES = {"Block": BLOCK, "BlockSignature": BLOCK_SIGNATURE, "SnapshotSignature": SNAPSHOT_SIGNATURE, "Transaction": TRANSACTION, "AccessListEntry": ACCESS_LIST_ENTRY, "Log": LOG}
DELETE_ORDER = ("BlockSignature", "AccessListEntry", "Log", "Transaction", "Block")
HEIGHT = {"Block": "number", "BlockSignature": "blockNumber", "Transaction": "blockNumber", "AccessListEntry": "blockNumber", "Log": "blockNumber"}
KEYS = {"Block": ["number"], "BlockSignature": ["blockNumber"], "SnapshotSignature": ["snapshotFile"], "Transaction": ["hash"], "AccessListEntry": ["doc_id"], "Log": ["blockHash", "logIndex"]}
IDS = StructType([StructField("doc_id", StringType()), StructField("cid", BinaryType())])
#: microseconds at which a row's commit was made; no rewriting of files changes it
META = StructType([StructField("commit", LongType())])

_TX = TRANSACTION.fieldNames()
RAW_TRANSACTION = StructType([StructField(n, StringType()) for n in _TX if n not in ("block_id", "blockNumber", "transactionIndex", "status")] + [StructField("blockNumber", StringType()), StructField("transactionIndex", LongType()), StructField("status", BooleanType()), StructField("accessList", ArrayType(_struct("address", "", "storageKeys")))])
RAW_BLOCK = StructType([*(StructField(n, StringType()) for n in BLOCK.fieldNames() if n != "uncles"), StructField("uncles", ArrayType(StringType())), StructField("transactions", ArrayType(RAW_TRANSACTION)), StructField("_corrupt_record", StringType())])
RAW_LOG = _struct("address data blockNumber transactionHash blockHash", "transactionIndex logIndex", "topics", "removed")
RAW_RECEIPT = StructType([*(StructField(n, StringType()) for n in "transactionHash transactionIndex blockHash blockNumber from to cumulativeGasUsed gasUsed contractAddress status".split()), StructField("logs", ArrayType(RAW_LOG)), StructField("_corrupt_record", StringType())])


def prefix(chain: str | None = None, network: str | None = None) -> str:
    return f"{chain or 'Ethereum'}__{network or 'Mainnet'}"


def collection_name(of: str, chain: str | None = None, network: str | None = None) -> str:
    return f"{prefix(chain, network)}__{of}"


def type_of(name: Column) -> Column:
    """Type part of a collection name, '' if it is none of ours."""
    kind = F.regexp_extract(name, "^[^_]+__[^_]+__([A-Za-z]+)$", 1)
    return F.when(kind.isin(list(TABLES)), kind).otherwise("")


def file_stem(kind: Column) -> Column:
    return F.when(kind.isin(list(TABLES)), F.concat(F.lower(F.substring(kind, 1, 1)), F.substring(kind, 2, 99))).otherwise("")


def list_collections(spark: SparkSession, chain: str | None = None, network: str | None = None) -> DataFrame:
    rows = [(collection_name(k, chain, network), k, f.name, f.dataType.simpleString()) for k, s in TABLES.items() for f in s.fields]
    return spark.createDataFrame(rows, "collection string, type string, field string, kind string")


def ensure(spark: SparkSession, root: str, of: str, wanted: StructType | None = None) -> StructType:
    """The table's schema with new columns added; raises where a column would be dropped or change its type.

    The schema stands in one file beside the data, so that an append reads that and not the footers of the whole table.
    """
    wanted = wanted or StructType([*IDS.fields, *TABLES[of].fields])
    wanted = StructType([*(f for f in wanted.fields if f.name not in META.fieldNames()), *META.fields])
    path = f"{root}/{of}"
    jvm = spark.sparkContext._jvm
    note = jvm.org.apache.hadoop.fs.Path(f"{path}/_schema.json")
    fs = note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(note):
        stream = fs.open(note)
        have = StructType.fromJson(json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        stream.close()
        if have == wanted:
            return wanted
    elif fs.exists(note.getParent()):
        try:
            have = spark.read.option("mergeSchema", "true").parquet(path).schema
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            have = StructType()
    else:
        have = StructType()
    kinds = {f.name: f.dataType for f in wanted.fields}
    for f in have.fields:
        if f.name not in ("chain", "block_bucket") and kinds.get(f.name, None) != f.dataType:
            raise ValueError(f"{of}.{f.name}: {f.dataType.simpleString()} may not become {kinds[f.name].simpleString() if f.name in kinds else 'nothing'}")
    out = fs.create(note, True)
    out.write(bytearray(wanted.json().encode()))
    out.close()
    return wanted
