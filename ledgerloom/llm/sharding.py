"""Shards of near equal bytes by a k-d tree over document metadata, in DataFrame functions only.

A node of the tree holds k shards and is split into k//2 and the rest, at the weighted quantile of its widest metadata
dimension, until a leaf is one shard with its share of the bytes. A dimension's width in a node is its spread, weighted by
bytes, against its spread in the whole table; categories are coded by the rank of their bytes. Where equal texts, which
stay together, make the cut of the widest dimension miss by more than a little, the next dimensions are tried. All nodes
of a level are split by the same few aggregations, each of which returns at most nodes x BINS sums to the driver, whatever
the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .scratch import done, saved

BINS = 4096
#: size of a document, bytes of its group of equal texts, language, source, place of its doc_id
DIMS = ("c_size", "c_group", "c_lang", "c_source", "c_id")
#: what a cut may miss, of one shard's bytes, before another dimension is tried
MISS = 0.01


@dataclass
class Node:
    """shards first..first+count-1; once split: rows with (dimension, tie bin) below (code, cut) go left."""

    first: int
    count: int
    dim: str | None = None
    code: int = 0
    cut: int = 0
    left: "Node | None" = None
    right: "Node | None" = None


def _bin(tie: str = "tie") -> Column:
    return F.shiftrightunsigned(tie, 52)


def _leaf(node: Node) -> Column:
    """The first shard of the node that a row has reached."""
    if node.left is None:
        return F.lit(node.first)
    c = F.col(node.dim)
    return F.when((c < node.code) | ((c == node.code) & (_bin() < node.cut)), _leaf(node.left)).otherwise(_leaf(node.right))


def _cross(sums: dict[int, int], target: float) -> tuple[int, float]:
    """The first key at which the running sum reaches target, and what is missing before it."""
    run = 0
    for key in sorted(sums):
        if run + sums[key] >= target:
            return key, target - run
        run += sums[key]
    return key, sums[key]


def _cuts(rows: DataFrame, dims: dict[int, str], nodes: dict[int, Node], weight: dict[int, int]) -> dict[int, tuple[int, int, float]]:
    """For each node that dims names, (code, cut, bytes missed) of the cut in that dimension nearest to its aim."""
    of = lambda make: F.coalesce(*(F.when(F.col("node") == n, make(n, d)) for n, d in dims.items()))
    rows = rows.where(F.col("node").isin(list(dims)))
    sums: dict[int, dict[int, int]] = {n: {} for n in dims}
    for r in rows.groupBy("node", of(lambda n, d: F.col(d)).alias("code")).agg(F.sum("size").alias("w")).collect():
        sums[r["node"]][r["code"]] = r["w"]
    at = {n: _cross(sums[n], weight[n] * (nodes[n].count // 2) / nodes[n].count) for n in dims}
    ties: dict[int, dict[int, int]] = {n: {} for n in dims}
    for r in rows.where(of(lambda n, d: F.col(d) == at[n][0])).groupBy("node", _bin().alias("bin")).agg(F.sum("size").alias("w")).collect():
        ties[r["node"]][r["bin"]] = r["w"]
    out = {}
    for n, (code, missing) in at.items():
        b, rest = _cross(ties[n], missing)
        after = 2 * rest >= ties[n][b]  # the nearer of the two borders of that bin
        out[n] = (code, b + after, float(abs(ties[n][b] - rest) if after else rest))
    return out


def _split_level(points: DataFrame, tree: Node, level: list[Node], whole: dict[str, float], shard_bytes: float) -> None:
    nodes = {n.first: n for n in level}
    rows = points.withColumn("node", _leaf(tree)).where(F.col("node").isin(list(nodes)))
    size = F.col("size").cast("double")
    spread = rows.groupBy("node").agg(F.sum("size").alias("w"), *(F.struct(F.sum(size * F.col(d)), F.sum(size * F.col(d) * F.col(d))).alias(d) for d in DIMS)).collect()
    weight = {r["node"]: r["w"] for r in spread}
    order: dict[int, list[str]] = {}
    for r in spread:
        width = {d: max(0.0, r[d][1] / r["w"] - (r[d][0] / r["w"]) ** 2) ** 0.5 for d in DIMS}
        if r["node"] == 0 and len(level) == 1:
            whole |= width
        order[r["node"]] = sorted(DIMS, key=lambda d: (-width[d] / whole[d] if whole[d] else 0.0, DIMS.index(d)))
    best: dict[int, tuple[float, str, int, int]] = {}
    for k in range(len(DIMS)):
        open_ = {n: order[n][k] for n in order if n not in best or best[n][0] > MISS * shard_bytes}
        if not open_:
            break
        for n, (code, cut, miss) in _cuts(rows, open_, nodes, weight).items():
            best[n] = min(best.get(n, (float("inf"),)), (miss, open_[n], code, cut), key=lambda x: x[0])
    for n in level:
        _, n.dim, n.code, n.cut = best.get(n.first, (0.0, DIMS[0], 0, 0))
        n.left, n.right = Node(n.first, n.count // 2), Node(n.first + n.count // 2, n.count - n.count // 2)


def _ranked(rows: DataFrame, code: str) -> DataFrame:
    """code, rank: bins of a category by falling bytes; no more rows than BINS."""
    sums = rows.groupBy(code).agg(F.sum("size").alias("w")).collect()
    ranks = [(r[code], i) for i, r in enumerate(sorted(sums, key=lambda r: (-r["w"], r[code])))]
    return F.broadcast(rows.sparkSession.createDataFrame(ranks, f"{code} int, {code}_rank int"))


def shard(docs: DataFrame, shards: int = 24, piece: float = 0.005) -> DataFrame:
    """Law `bytes`: every document goes to one of `shards` shards whose sizes are near equal.

    A document's size is the UTF-8 bytes of its text (null: none) plus 8. Equal texts share their coordinates (those of
    their smallest doc_id) and so go to one shard. Only a group that is larger than a whole shard's share of the bytes
    cannot: its rows are dealt out by doc_id, in pieces of at most `piece` of a shard. Texts are not read past their bytes,
    so long ones cost no more; one text larger than a shard's share makes its shard larger. A null doc_id, language or
    source has a coordinate of its own; repeated rows are rows of their own; an empty table gives an empty result; other
    columns of docs are ignored. Slots count from 0 without gaps in each shard.
    """
    text = F.coalesce("text", F.lit(""))
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(BINS)).cast("int")
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit(7), text).alias("h2"),
            hashed("lang").alias("lang_code"),
            hashed("source").alias("source_code"),
        ),
        "shard-rows",
    )
    total, low, high = rows.agg(F.sum("size"), F.min("doc_id"), F.max("doc_id")).first()
    groups = rows.groupBy("h1", "h2", "size").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "lang_code", "source_code")).alias("of"))
    target = max(1.0, (total or 0) / shards)
    place = (F.coalesce(F.col("of.doc_id"), F.lit(low or 0)) - F.lit(low or 0)).cast("double") / float((high or 0) - (low or 0) + 1)
    held = F.col("copies") * F.col("size")
    pieces = F.when(held > target, F.ceil(held / (target * piece))).otherwise(1)
    groups = groups.select("*", "of.lang_code", "of.source_code").join(_ranked(rows, "lang_code"), "lang_code").join(_ranked(rows, "source_code"), "source_code")
    groups = groups.select(
        "h1", "h2", "size",
        F.least(F.floor(F.log2("size") * 64), F.lit(BINS - 1)).cast("int").alias("c_size"),
        F.when(held > target, 0).otherwise(F.least(F.floor(F.log2(held) * 64), F.lit(BINS - 1))).cast("int").alias("c_group"),
        F.col("lang_code_rank").alias("c_lang"),
        F.col("source_code_rank").alias("c_source"),
        F.floor(place * BINS).cast("int").alias("c_id"),
        pieces.cast("long").alias("pieces"),
    )
    groups = saved(groups, "shard-groups")  # so that a large group's rows can be split in the join
    piece = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.col("pieces"))
    points = saved(rows.join(groups, ["h1", "h2", "size"]).select("doc_id", "size", "text_crc32", *DIMS, F.xxhash64("h1", "h2", piece).alias("tie")), "shard-points")
    done(rows, groups)
    tree = Node(0, shards)
    level, whole = [tree], dict.fromkeys(DIMS, 0.0)
    while level := [n for n in level if n.count > 1]:
        _split_level(points, tree, level, whole, target)
        level = [x for n in level for x in (n.left, n.right)]
    placed = saved(
        points.select("doc_id", "size", "text_crc32", _leaf(tree).alias("shard")).sortWithinPartitions("shard").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)),
        "shard-placed",
    )
    done(points)
    runs = placed.groupBy("part", "shard").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = saved(runs.select("part", "shard", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift")), "shard-runs")
    return placed.join(runs, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("at") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
