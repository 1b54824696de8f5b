"""Roots of snapshots recomputed and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import key_type
from ..functions.merkle import root


def roots(leaves: DataFrame) -> DataFrame:
    """snapshotFile, computed, n_roots from (snapshotFile, blockNumber, root[, line]) in block order."""
    line = F.col("line") if "line" in leaves.columns else F.lit(0)
    order = F.struct(F.coalesce("blockNumber", line.cast("long")).alias("n"), line.alias("l"), F.unhex("root").alias("r"))
    sorted_ = leaves.groupBy("snapshotFile").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["r"]).alias("r"))
    return sorted_.select("snapshotFile", F.lower(F.hex(root(F.col("r")))).alias("computed"), F.size("r").cast("long").alias("n_roots"))


def report(signature_rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """One row a signed snapshot: n_roots, computed, claimed, root_match, key_type, signature_valid (unknown here), valid, error."""
    claimed = signature_rows.select("snapshotFile", F.lower("merkleRoot").alias("claimed"), "startBlock", "endBlock", key_type(F.col("signatureType")).alias("key_type"))
    out = claimed.join(roots(leaves), "snapshotFile", "left").withColumn("n_roots", F.coalesce("n_roots", F.lit(0)))
    match = F.coalesce(F.col("computed") == F.col("claimed"), F.lit(False))
    error = F.when(F.col("n_roots") == 0, "no block roots found").when(~match, "root differs").when(F.col("key_type") == "unsupported", "unsupported signature type")
    return out.withColumns({"root_match": match, "signature_valid": F.lit(None).cast("boolean"), "error": error}).withColumn("valid", F.col("error").isNull())
