"""Boilerplate lines by the number of distinct sites that carry them, in DataFrame functions only.

One HyperLogLog sketch of sites a line hash, merged by aggregation; only lines whose estimate lies near the threshold
get an exact distinct count. Lines are moved as two 64-bit hashes; texts move once, to be rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import saved

KEY = ["h1", "h2"]


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _row() -> Column:
    """Rows with equal doc_id and text have equal hits; others, also those without a doc_id, are told apart."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def lines_of(docs: DataFrame, site: str = "source") -> DataFrame:
    """A row for each line with a word: row (a hash of doc_id and text), site, position, two hashes of the trimmed line."""
    cut = docs.select(_row().alias("row"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "raw"))
    line = _trimmed(F.col("raw"))
    return cut.withColumn("line", line).where("line <> ''").select("row", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int, log2_buckets: int = 8) -> DataFrame:
    """Hashes of lines on min_sites distinct sites or more.

    The estimate's relative error is 1.04 / sqrt(2^log2_buckets), 6.5 % at 8; within four such errors of the threshold
    (and one site at least) the exact count decides.
    """
    slack = max(1.0, min_sites * 4 * 1.04 / 2 ** (log2_buckets / 2))
    spread = lines.groupBy(*KEY).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log2_buckets))).alias("sites"), F.count("*").alias("n"))
    spread = saved(spread.where((F.col("n") >= min_sites) & (F.col("sites") >= min_sites - slack)), "line-spread")
    near = spread.where(F.col("sites") < min_sites + slack).select(*KEY)
    exact = lines.join(near, KEY, "left_semi").groupBy(*KEY, "site").agg(F.lit(1).alias("one")).groupBy(*KEY).agg(F.count("*").alias("exact")).where(F.col("exact") >= min_sites)
    return spread.where(F.col("sites") >= min_sites + slack).select(*KEY).unionByName(exact.select(*KEY))


def remove_lines(docs: DataFrame, min_sites: int = 10, site: str = "source") -> DataFrame:
    """Texts without the lines that stand on `min_sites` distinct sites or more: doc_id, n_lines, n_removed, text.

    A line counts without white space at its ends; blank lines are never boilerplate and stay where they are. A null
    site is a site of its own, a null text is an empty text, an empty table gives an empty result. Rows that repeat a
    doc_id are texts of their own. n_lines and n_removed count lines with a word. Texts of any length are read whole; the
    lines of one text are one array of its task.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(site).cast("string").alias("site"))
    lines = saved(lines_of(docs, "site"), "line-hashes")
    bad = saved(boilerplate(lines, min_sites).distinct(), "line-boilerplate")
    hit = lines.join(bad, KEY, "left_semi").select("row", "pos", *KEY).distinct()
    hits = hit.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "h1", "h2"))).alias("hits"))  # of one text
    both = docs.withColumn("row", _row()).join(hits, "row", "left")
    # A map keyed by position and hash holds also where two rows share a hash.
    keyed = F.map_from_arrays(F.transform("hits", lambda x: F.concat_ws(",", x["pos"], x["h1"], x["h2"])), F.transform("hits", lambda x: x["pos"]))
    parts = F.split("text", "\n")
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")

    def drop(x: Column, i: Column) -> Column:
        t = _trimmed(x)
        return F.map_contains_key(F.col("keyed"), F.concat_ws(",", i, F.xxhash64(t), F.xxhash64(F.lit(7), t)))

    clean = F.when(F.col("hits").isNull(), F.col("text")).otherwise(F.array_join(F.filter(parts, lambda x, i: ~(has_word(x) & drop(x, i))), "\n"))
    both = both.withColumn("keyed", F.when(F.col("hits").isNotNull(), keyed)).withColumn("clean", clean)
    count = lambda c: F.size(F.filter(F.split(c, "\n"), has_word)).cast("long")
    both = both.withColumn("n_lines", count("text"))
    return both.select("doc_id", "n_lines", (F.col("n_lines") - F.when(F.col("hits").isNull(), F.col("n_lines")).otherwise(count("clean"))).alias("n_removed"), F.col("clean").alias("text"))
