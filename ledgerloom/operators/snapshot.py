"""Snapshots of aligned height ranges: plan, roots, records, export, restore, catalog."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.merkle import grown, peaks_root, root
from ..sources.schema import HEIGHT
from ..sources.tables import append_new, read
from .ops import log_run

MAGIC, VERSION = "LLSNAP", 1
VALID_HEX = "^([0-9a-fA-F]{2})+$"


def plan(blocks: DataFrame, per_file: int, last_end: int | None = None) -> DataFrame:
    """start, end, present, complete for every closed aligned range after last_end."""
    up = lambda n: -(-n // per_file) * per_file
    low, high = blocks.agg(F.min("number"), F.max("number")).first()
    first = None if low is None else up(low) if last_end is None or last_end + 1 < low else last_end + 1
    files = 0 if first is None else max(0, (high + 1 - first) // per_file)
    first = first or 0
    ranges = blocks.sparkSession.range(first, first + files * per_file, per_file).select(F.col("id").alias("start"), (F.col("id") + per_file - 1).alias("end"))
    held = blocks.select("number").where(F.col("number").between(first, first + files * per_file - 1)).distinct().groupBy(_start_of("number", first, per_file)).agg(F.count("*").alias("present"))
    return ranges.join(held, "start", "left").select("start", "end", F.coalesce("present", F.lit(0)).alias("present"), (F.coalesce("present", F.lit(0)) == per_file).alias("complete"))


def _start_of(height: str, base: int, per_file: int) -> Column:
    """Start of the range that a height lies in."""
    return (F.expr(f"({height} - {base}) div {per_file}") * per_file + base).cast("long").alias("start")


def range_roots(signatures: DataFrame, ranges: DataFrame, per_file: int) -> DataFrame:
    """start, end, roots (hex, in block order): roots that are not valid hex are left out."""
    ok = signatures.where(F.col("merkleRoot").rlike(VALID_HEX)).select("blockNumber", F.lower("merkleRoot").alias("r"), F.coalesce("createdAt", F.lit("")).alias("at"), "doc_id")
    base = ranges.agg(F.min("start")).first()[0] or 0
    keyed = ok.where(F.col("blockNumber") >= base).withColumn("start", _start_of("blockNumber", base, per_file))
    sorted_ = keyed.groupBy("start").agg(F.transform(F.array_sort(F.collect_list(F.struct("blockNumber", "at", "doc_id", "r"))), lambda x: x["r"]).alias("roots"))
    return ranges.select("start", "end").join(sorted_, "start", "left").withColumn("roots", F.coalesce("roots", F.array().cast("array<string>")))


PEAKS = "group long, n long, peaks array<binary>, last long, part long, chain string"


def grow_roots(spark: SparkSession, root: str, chain: str, signatures: DataFrame, group: Column, part: int) -> DataFrame:
    """Adds block roots (blockNumber, merkleRoot) to growing trees, one a group of heights; group, n, root of those it touched.

    Stored are the nodes of full aligned subtrees: a batch hashes its own leaves and the right edge of each tree. Roots
    that are not valid hex, and heights at or below the last one that a tree has, are left out; parts rise, and the same
    part again replaces itself.
    """
    stored = read(spark, f"{root}/Peaks", PEAKS).where((F.col("chain") == chain) & (F.col("part") < part))
    before = stored.groupBy("group").agg(F.max_by(F.struct("n", "peaks", "last"), "part").alias("b")).select("group", "b.*")
    ok = signatures.where(F.col("merkleRoot").rlike(VALID_HEX)).select(group.cast("long").alias("group"), "blockNumber", F.unhex("merkleRoot").alias("leaf"))
    fresh = ok.join(before.select("group", "last"), "group", "left").where("last is null or blockNumber > last")
    leaves = fresh.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("blockNumber", "leaf"))).alias("l"))
    rows = leaves.join(before.select("group", "n", "peaks"), "group", "left")
    tree = grown(F.coalesce("n", F.lit(0)), F.coalesce("peaks", F.array().cast("array<binary>")), F.col("l.leaf"))
    out = rows.select("group", tree.alias("t"), F.element_at("l", -1)["blockNumber"].alias("last")).select("group", "t.n", "t.peaks", "last")
    path = f"{root}/Peaks/chain={chain}/part={part}"
    out.write.mode("overwrite").parquet(path)
    done = spark.read.schema("group long, n long, peaks array<binary>, last long").parquet(path)
    return done.select("group", "n", F.lower(F.hex(peaks_root(F.col("peaks")))).alias("root"))


def record(rooted: DataFrame, created_at: str) -> DataFrame:
    """One attestation a range with roots; blockCount is the number of valid roots, expected_blocks that of heights."""
    return rooted.where(F.size("roots") > 0).select(
        F.col("start").alias("startBlock"), F.col("end").alias("endBlock"),
        F.lower(F.hex(root(F.transform("roots", lambda x: F.unhex(x))))).alias("merkleRoot"),
        F.size("roots").cast("long").alias("blockCount"), (F.col("end") - F.col("start") + 1).alias("expected_blocks"),
        file_name(F.col("start"), F.col("end")).alias("snapshotFile"), F.lit(created_at).alias("createdAt"), F.col("roots").alias("blockSigMerkleRoots"),
    )


def file_name(start: Column, end: Column) -> Column:
    return F.concat(F.lit("snapshot_"), start.cast("string"), F.lit("_"), end.cast("string"))


def export(tables: Mapping[str, DataFrame], ranges: DataFrame, path: str, roots: DataFrame | None = None, chain: str = "") -> DataFrame:
    """Writes all ranges of all tables in one job a table, and the manifest last: a range without manifest row does not exist.

    Each run writes below a new name, so a failed one leaves nothing that is read. ranges are of equal length.
    """
    spark, run = ranges.sparkSession, uuid.uuid4().hex
    bounds = ranges.select("start", "end")
    base, per_file = ranges.agg(F.min("start"), F.min(F.col("end") - F.col("start") + 1)).first()
    counts = {}
    for name, df in tables.items():
        seen = counts[name] = Observation()
        rows = df.where(F.col(HEIGHT[name]) >= (base or 0)).withColumn("range_start", _start_of(HEIGHT[name], base or 0, per_file or 1))
        rows.join(bounds.select(F.col("start").alias("range_start")), "range_start", "left_semi").observe(seen, F.count("*").alias("n")).write.option("compression", "zstd").partitionBy("range_start").parquet(f"{path}/data/{run}/{name}")
    manifest = bounds.select(F.lit(MAGIC).alias("magic"), F.lit(VERSION).alias("version"), F.lit(chain).alias("chain"), F.lit(run).alias("run"), "start", "end", file_name(F.col("start"), F.col("end")).alias("snapshotFile"), F.lit(",".join(tables)).alias("collections"))
    if roots is not None:
        manifest = manifest.join(roots.select("start", "roots"), "start", "left")
    manifest = manifest.withColumn("written_at", F.current_timestamp())
    manifest.write.mode("append").parquet(f"{path}/manifest")
    docs = {k: seen.get["n"] for k, seen in counts.items()}
    log_run(spark, path, "export", base or 0, chain, rows=sum(docs.values()), blocks=docs.get("Block", 0), docs=sum(docs.values()), last_block=ranges.agg(F.max("end")).first()[0])
    return spark.read.parquet(f"{path}/manifest").where(F.col("run") == run)


def restore(spark: SparkSession, path: str, file: str, into: str, chain: str) -> DataFrame:
    """Appends what the tables lack of one snapshot; returns start and end. Raises on a foreign or missing manifest row."""
    rows = spark.read.parquet(f"{path}/manifest").where(F.col("snapshotFile") == file).orderBy("written_at", "run").collect()
    if not rows:
        raise FileNotFoundError(file)
    m = rows[-1]  # the last run that wrote it
    if m["magic"] != MAGIC or m["version"] != VERSION or m["start"] > m["end"]:
        raise ValueError(f"{file} is not a snapshot of version {VERSION}")
    for name in m["collections"].split(","):
        part = spark.read.parquet(f"{path}/data/{m['run']}/{name}").where(F.col("range_start") == m["start"]).drop("range_start")
        append_new(part, into, name, chain, heights=(m["start"], m["end"]))
    return spark.createDataFrame([(m["start"], m["end"])], "start long, end long")


def read_roots_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """snapshotFile, blockNumber, root from JSON lines, plain or gz; other records, bad JSON and bad hex are left out."""
    rows = spark.read.text(path).select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("snapshotFile"), F.from_json("value", "type string, data struct<merkleRoot: string, blockNumber: long>").alias("j"), F.monotonically_increasing_id().alias("line"))
    ok = rows.where((F.col("j.type") == "block_signature") & F.col("j.data.merkleRoot").rlike(VALID_HEX))
    return ok.select("snapshotFile", F.col("j.data.blockNumber").alias("blockNumber"), F.lower("j.data.merkleRoot").alias("root"), "line")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """snapshotFile, start, end, size, modified of files named snapshot_<start>_<end>..., others left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    name = F.regexp_extract("path", "([^/]+)$", 1)
    bounds = lambda i: F.regexp_extract(name, r"^snapshot_(\d+)_(\d+)", i).try_cast("long")
    return files.select(name.alias("snapshotFile"), bounds(1).alias("start"), bounds(2).alias("end"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")).where("start is not null").orderBy("start")


def signatures(rows: DataFrame) -> DataFrame:
    """The last signature of each file; rows without a file name are left out."""
    rows = rows.where(F.col("snapshotFile") != "")
    cols = rows.columns
    last = rows.groupBy("snapshotFile").agg(F.max_by(F.struct(*cols), F.struct(F.coalesce("createdAt", F.lit("")), F.col("merkleRoot"))).alias("r"))
    return last.select("r.*")


def catalog_signed(files: DataFrame, signature_rows: DataFrame) -> DataFrame:
    s = signatures(signature_rows).select("snapshotFile", F.col("merkleRoot").alias("root"))
    return files.join(s, "snapshotFile", "left").withColumn("signed", F.col("root").isNotNull())
