"""Merkle manifest of a dataset by time-forward processing.

Nodes are labelled by (height, tree, place), so that a parent's label is greater than its children's. A forward sweep takes
messages out of an external priority queue in the order of labels: each node hashes the digests that its children sent and
sends its own to its parent. A reversed sweep takes labels downwards: each node sends to its children what their proofs end
with, which is the child's siblings and then all that the node itself was sent. A leaf is thereby sent its whole proof, and
no node ever looks up another one.

Each source is a tree over its documents and the sources' roots are the leaves of one tree above them. A node has up to 16
children, so a source of a third of all rows is no larger a group than any other; the places of leaves come from ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .scratch import done, saved

RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: height of the lowest runs of the tree over sources; no tree of documents is as high
ABOVE = 100
STEPS = "array<struct<left: binary, right: binary>>"


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _low(c: Column) -> Column:
    return F.lower(F.hex(c))


def leaf_of(*values: Column) -> Column:
    """Digest of a row's values: `-` for null, else the count of UTF-8 bytes, a colon and the value."""
    parts = [v.cast("string") for v in values]
    return _sha(F.concat(*(F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in parts)))


class Queue:
    """Messages (tree, place, child, n, digest) to the nodes of one height and more, lowest labels first.

    It is external: what waits lies as Parquet below spark.checkpoint.dir. Height leads the label, so the messages of one
    height come before all higher ones and are taken together; within them Spark's shuffle is by tree and place.
    """

    def __init__(self) -> None:
        self.waiting: dict[int, list[DataFrame]] = {}

    def put(self, height: int, messages: DataFrame) -> None:
        self.waiting.setdefault(height, []).append(messages)

    def take(self, highest_first: bool = False) -> tuple[int, DataFrame] | None:
        if not self.waiting:
            return None
        height = (max if highest_first else min)(self.waiting)
        first, *others = self.waiting.pop(height)
        for o in others:
            first = first.unionByName(o)
        return height, first


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds place, from 0 in each tree by `order`, and n, the rows of the tree; rows that tie get places next to one another.

    Rows are dealt by ranges of (tree, order, place in the file), so no tree has to fit a task, however often a row repeats;
    a range's first place is the sum of the counts of the ranges before it.
    """
    rows = saved(rows, "manifest-rows")
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "_tie").sortWithinPartitions("tree", *order, "_tie")
    dealt = saved(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "manifest-dealt")
    done(rows)
    counts = dealt.groupBy("tree", "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    tree = W.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = counts.select("tree", "_range", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("n"))
    return dealt.join(shift, ["tree", "_range"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _run(digest: Column) -> Column:
    """Digests of an array as one hex text."""
    return F.array_join(F.transform(digest, _low), "")


def runs(messages: DataFrame, *more: str) -> DataFrame:
    """What nodes make of their messages: tree, place, n (nodes of their height), kids (digests in order) and digest.

    A tree of one leaf has no runs: the leaf itself is what remains. more: columns of the children, kept in `rows`.
    """
    kids = F.array_sort(F.collect_list(F.struct("child", "digest", *more)))
    out = messages.groupBy("tree", "place").agg(F.max("n").alias("_n"), kids.alias("rows")).withColumn("_hex", _run(F.col("rows.digest")))
    digest = F.when(F.col("_n") == 1, F.unhex("_hex")).otherwise(_sha(F.col("_hex")))
    out = out.select("tree", "place", F.ceil(F.col("_n") / RUN).cast("long").alias("n"), F.unhex("_hex").alias("kids"), digest.alias("digest"), (F.col("_n") == 1).alias("lone"), "rows")
    return out if more else out.drop("rows")


def _to_parents(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.select("tree", F.expr(f"place div {RUN}").alias("place"), F.col("place").alias("child"), "n", "digest", *more)


def _to_children(nodes: DataFrame) -> DataFrame:
    """What the nodes' children are sent: child's place, and its steps up to the root."""
    out = nodes.select("tree", "place", "steps", "kids", "lone", F.explode(F.sequence(F.lit(0), F.floor(F.octet_length("kids") / 32).cast("int") - 1)).alias("_k"))
    return out.select("tree", (F.col("place") * RUN + F.col("_k")).alias("place"), _steps(F.col("_k")).alias("steps"))


def _steps(k: Column) -> Column:
    """A child's own step, its siblings to the left and to the right, before those of its parent."""
    own = F.struct(F.substr("kids", F.lit(1), k * 32).alias("left"), F.substr("kids", k * 32 + 33, F.octet_length("kids")).alias("right"))
    return F.when(F.col("lone"), F.col("steps")).otherwise(F.concat(F.array(own), F.col("steps")))


def folded(leaf: Column, steps: Column) -> Column:
    """Root (lowercase hex) that a leaf and the steps of a proof lead to."""
    return F.aggregate(steps, _low(leaf), lambda node, s: F.sha2(F.concat(_low(s["left"]), node, _low(s["right"])), 256))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(_low(s["left"]), _low(s["right"]))), ""), 256)


@dataclass
class Manifest:
    """root: lowercase hex, None of an empty table; sources: source, subroot; proofs: doc_id, leaf, changed, source, subroot, steps."""

    root: str | None
    sources: DataFrame
    proofs: DataFrame


def _source(tree: str = "tree") -> Column:
    return F.when(F.substring(tree, 1, 1) == "1", F.substring(tree, 2, 1 << 30))


def manifest(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """Builds the manifest of a documents table (doc_id, source, lang, n_chars, text) and the proof of each row.

    changed: a text in whose place a row's own text is tampered with (NULL: not); `changed` is then the leaf with it, else
    the leaf. Leaves ascend by doc_id, null ones first, then by digest; repeated rows are leaves next to one another. Null
    and empty sources are different trees. Other columns are ignored; an empty table has no root and no proofs.
    """
    spark: SparkSession = docs.sparkSession
    own = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("binary") if changed is None else F.when(changed.isNotNull(), leaf_of(*own[:-1], changed))
    rows = docs.select(F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source").cast("string"))).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(*own).alias("digest"), other.alias("changed"))
    leaves = placed(rows, "doc_id", "digest")
    # forward: children's digests to their parents
    queue, made, roots = Queue(), {}, []
    queue.put(1, _to_parents(leaves, "doc_id", "changed"))
    while message := queue.take():
        height, mail = message
        made[height] = saved(runs(mail, "doc_id", "changed") if height == 1 else runs(mail), f"manifest-{height}")
        low = height < ABOVE
        widest = made[height].agg(F.max("n")).first()[0]
        if low and widest is not None:
            roots.append(made[height].where("n = 1").select("tree", "digest", F.lit(height).alias("_height")))
        if widest and widest > 1:
            queue.put(height + 1, _to_parents(made[height].where("n > 1")))
        elif low and roots:
            subroots = saved(_union(roots), "manifest-subroots")
            top = saved(placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_of"), "digest", "_height"), "_of"), "manifest-top")
            queue.put(ABOVE, _to_parents(top))
    if not roots:
        nothing = spark.createDataFrame([], f"doc_id long, leaf binary, changed binary, source string, subroot string, steps {STEPS}")
        return Manifest(None, nothing.select("source", "subroot"), nothing)
    # reversed: the ends of proofs to the children
    root = bytes(made[max(made)].select("digest").first()[0]).hex()
    empty = F.array().cast(STEPS)
    sent = made[max(made)].select("tree", "place", empty.alias("steps"))
    ends = None
    for height in sorted(made, reverse=True):
        if height == ABOVE:  # what a source's root is sent goes to the runs at the top of its own tree
            above = saved(_to_children(made[height].join(sent, ["tree", "place"])), f"manifest-sent-{height}")
            ends = saved(top.join(above.select("place", "steps"), "place").select(F.col("_of").alias("tree"), F.lit(0).cast("long").alias("place"), "steps", "_height"), "manifest-ends")
            sent = None
            continue
        if height < ABOVE:
            mine = ends.where(F.col("_height") == height).select("tree", "place", "steps")
            sent = mine if sent is None else sent.unionByName(mine)
        nodes = made[height].join(sent, ["tree", "place"])
        if height > 1:
            sent = saved(_to_children(nodes), f"manifest-sent-{height}")
    nodes = nodes.join(subroots.select("tree", _low(F.col("digest")).alias("subroot")), "tree")
    out = nodes.select("tree", "subroot", "steps", "kids", "lone", F.posexplode("rows").alias("_k", "_r"))
    proofs = out.select("_r.doc_id", F.col("_r.digest").alias("leaf"), F.coalesce("_r.changed", "_r.digest").alias("changed"), _source().alias("source"), "subroot", _steps(F.col("_k")).alias("steps"))
    return Manifest(root, subroots.select(_source().alias("source"), _low(F.col("digest")).alias("subroot")), proofs)


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *others = parts
    for o in others:
        first = first.unionByName(o)
    return first


def verified(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """A row for each document: doc_id, leaf, subroot, root, proof_sha256 of the table as it is; folded_root and verified
    from the leaf with the changed text, where there is one, and the proof of the table as it is. Rules are manifest()'s."""
    m = manifest(docs, changed)
    out = m.proofs.select("doc_id", _low(F.col("leaf")).alias("leaf"), "subroot", F.lit(m.root).cast("string").alias("root"), proof_digest(F.col("steps")).alias("proof_sha256"), folded(F.col("changed"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
