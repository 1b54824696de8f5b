"""Merkle roots as array folds, and the same roots from aligned chunks where a group has too many leaves for one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.tables import shared_folder


def _sha(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def fold(nodes: Column) -> Column:
    """Root of hashed nodes in order: neighbours are hashed together, an odd last node moves up as it is; NULL if none."""

    def level(a: Column, _: Column) -> Column:
        pair = lambda i: F.when(2 * i + 1 < F.size(a), _sha(F.concat(F.get(a, 2 * i), F.get(a, 2 * i + 1)))).otherwise(F.get(a, 2 * i))
        return F.when(F.size(a) <= 1, a).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / 2).cast("int")), pair))

    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(F.size(nodes), F.lit(1)))).cast("int") + 1)
    return F.get(F.aggregate(rounds, nodes, level), F.lit(0))


def root(leaves: Column) -> Column:
    return fold(F.transform(leaves, _sha))


def grown(n: Column, peaks: Column, leaves: Column) -> Column:
    """n, peaks after more leaves: nodes of the full aligned subtrees that the leaves so far fall into, the largest first.

    Their sizes are the binary digits of n. A leaf joins as many of the last ones as n ends in ones, so that leaves cost
    about two hashes each, however many there were before.
    """

    def push(tree: Column, leaf: Column) -> Column:
        have, size = tree["peaks"], F.size(tree["peaks"])
        joins = (F.bit_count(tree["n"].bitwiseXOR(tree["n"] + 1)) - 1).cast("int")
        node = F.aggregate(F.reverse(F.slice(have, size - joins + 1, joins)), _sha(leaf), lambda node, left: _sha(F.concat(left, node)))
        return F.struct((tree["n"] + 1).alias("n"), F.concat(F.slice(have, F.lit(1), size - joins), F.array(node)).alias("peaks"))

    return F.aggregate(leaves, F.struct(n.cast("long").alias("n"), peaks.alias("peaks")), push)


def peaks_root(peaks: Column) -> Column:
    """Root over the leaves that peaks stand for: as odd nodes move up, the smaller ones meet from the right."""
    return F.when(F.size(peaks) > 0, F.aggregate(F.reverse(F.slice(peaks, F.lit(1), F.size(peaks) - 1)), F.element_at(peaks, -1), lambda node, left: _sha(F.concat(left, node))))


def roots(leaves: DataFrame, by: list[str], order: str, leaf: str, bucket: Column, chunk_bits: int = 12) -> DataFrame:
    """Root a group of any size: by..., n_leaves, root.

    Leaves are ranked by `order` within their group and cut into aligned chunks of 2 ** chunk_bits; as odd nodes move up,
    a chunk's root is the node that covers it, and chunks of chunks are folded in the same way. bucket is a coarse
    integer that grows with `order`: ranks are counted within a bucket and shifted by the buckets before it, so no
    group's leaves have to sit in one task. The first chunks' roots are written to the shared folder: leaves are worked
    out once, and what is left has a row for each 2 ** chunk_bits of them.
    """
    spark = leaves.sparkSession
    rows = leaves.where(F.col(leaf).isNotNull()).select(*by, F.col(order).alias("_o"), F.col(leaf).alias("_leaf"), bucket.alias("_b"))
    sizes = rows.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = ["_o"] if order == leaf else ["_o", "_leaf"]
    ranked = rows.withColumn("_i", F.row_number().over(W.partitionBy(*by, "_b").orderBy(*inside)) - 1)
    ranked = ranked.join(sizes.select(*by, "_b", before.alias("_shift")), [*by, "_b"]).select(*by, (F.col("_i") + F.col("_shift")).alias("_i"), "_leaf")

    def chunks(level: DataFrame, node: str, *more: Column) -> DataFrame:
        own = F.transform(F.array_sort(F.collect_list(F.struct("_i", node))), lambda x: x[node])
        return level.groupBy(*by, F.shiftright("_i", chunk_bits).alias("_i")).agg(fold(own if node == "_node" else F.transform(own, _sha)).alias("_node"), *more)

    path = shared_folder(spark, "merkle")
    first = chunks(ranked, "_leaf", F.count("*").alias("_n"))
    first.write.parquet(path)
    first = spark.read.schema(first.schema).parquet(path)
    level, most = first.select(*by, "_i", "_node"), (first.agg(F.max("_i")).first()[0] or 0) + 1
    for _ in range(-(-(most - 1).bit_length() // chunk_bits)):  # until each group is one node
        level = chunks(level, "_node")
    return first.groupBy(*by).agg(F.sum("_n").alias("n_leaves")).join(level.select(*by, F.col("_node").alias("root")), by)


def byte_bucket(c: Column) -> Column:
    """The first byte of a binary value as an integer, in the order of the bytes; a group of a billion leaves has some four million in each."""
    return F.conv(F.hex(F.substring(c, 1, 1)), 16, 10).cast("int")
