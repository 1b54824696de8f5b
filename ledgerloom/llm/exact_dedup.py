"""Exact duplicates by a stream over keyed state that lasts.

Structured Streaming keeps one state row a digest in RocksDB, on disk, without expiry: the stable identifier and content
locator of the document that stays, and the group's size. Fingerprints of new documents land as Parquet and a triggered
run folds them in, with partial sums before the shuffle, so a group of copies of any size costs a row per task. Hits are
then held against full bytes, which are read back from the tables that the locators name, of earlier batches too.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import done, exists, folder, remove, saved, settings

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def located(spark: SparkSession, table: str, *columns: Column) -> DataFrame:
    """doc_id, text, locator (file and row of the Parquet table) and the given columns."""
    df = spark.read.parquet(table)
    place = df.metadataColumn("_metadata")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.concat_ws("#", place["file_path"], place["row_index"]).alias("locator"), *columns)


#: of equal texts the greatest stays: most code points, then a doc_id before none, the smallest, the earliest batch; ~x turns an order without overflow
def _best() -> Column:
    return F.struct("points", F.isnotnull("doc_id").alias("known"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("low_id"), F.bitwise_not("batch").alias("low_batch"), "locator")


FINGERPRINT = "doc_id long, digest string, text_sha256 string, points long, content string, locator string, batch long"


class ExactDedup:
    """State of one corpus in one folder: add() may be called again with later documents, also after a restart.

    A caller's own folder is never deleted here. One add() runs at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None):
        self.spark, self.path, self.digest, self.files = spark, path or folder(spark, "exact"), digest, files_per_batch
        self.rows = self.path + "/fingerprints"

    def add(self, docs: DataFrame | str) -> int:
        """Folds documents in and returns their batch's number.

        docs is the path of a Parquet table, which has to stay as it is since its rows' bytes are read again, or a
        DataFrame, which is written whole below the state's folder. A call that failed may be repeated: what it left
        unfinished is finished first, and where that was the same table, or a DataFrame of the same rows, nothing is added
        a second time.
        """
        unfinished = self._finish()
        if unfinished is not None and self._same(unfinished, docs):
            return unfinished
        batch = self._last() + 1
        table = docs if isinstance(docs, str) else self._content(batch)
        if not isinstance(docs, str):
            docs.write.mode("overwrite").parquet(table)
        norm = normalised()
        located(self.spark, table).select(
            "doc_id",
            self.digest(norm).alias("digest"),
            F.sha2(norm, 256).alias("text_sha256"),
            F.length("text").cast("long").alias("points"),
            F.lit(table).alias("content"),
            "locator",
        ).write.mode("overwrite").parquet(f"{self.rows}/batch={batch}")
        self._finish()
        return batch

    def _content(self, batch: int) -> str:
        return f"{self.path}/content-{batch:09d}"

    def _last(self) -> int:
        """Number of the last batch whose fingerprints are whole, -1 before the first."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.rows)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return max((int(n.split("=")[1]) for n in found if n.startswith("batch=") and exists(self.spark, f"{self.rows}/{n}/_SUCCESS")), default=-1)

    def _finish(self) -> int | None:
        """Folds in the last batch if that is still to be done; returns its number then."""
        batch = self._last()
        if batch < 0 or exists(self.spark, f"{self.path}/done/{batch}"):
            return None
        self._fold()
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/done/{batch}")
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
        return batch

    def _same(self, batch: int, docs: DataFrame | str) -> bool:
        """Whether these documents are those of a batch."""
        table = self.fingerprints().where(F.col("batch") == batch).select("content").head()
        if isinstance(docs, str) or table is None:
            return table is not None and table[0] == docs
        if table[0] != self._content(batch):
            return False
        had = self.spark.read.parquet(table[0])
        sums = [d.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(d.columns)))).cast("decimal(38,0)"))).first() for d in (had, docs)]
        return sorted(had.columns) == sorted(docs.columns) and sums[0] == sums[1]

    def fingerprints(self) -> DataFrame:
        return self.spark.read.schema(FINGERPRINT).parquet(self.rows)

    def _fold(self) -> None:
        reader = self.spark.readStream.schema(FINGERPRINT)
        if self.files:
            reader = reader.option("maxFilesPerTrigger", self.files)
        keyed = reader.parquet(self.rows).groupBy("digest").agg(F.max(_best()).alias("best"), F.count("*").alias("group_size"))
        out = self.path + "/updates"

        def put(changed: DataFrame, number: int) -> None:
            changed.write.mode("overwrite").parquet(f"{out}/batch={number:09d}")

        with settings(
            self.spark,
            spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
            spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false",
            spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
            spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="64",
        ):
            keyed.writeStream.outputMode("update").foreachBatch(put).trigger(availableNow=True).option("checkpointLocation", self.path + "/state").start().awaitTermination()

    def state(self) -> DataFrame:
        """One row a digest, as its last update has it."""
        updates = self.spark.read.parquet(self.path + "/updates")
        last = updates.groupBy("digest").agg(F.max(F.struct("batch", "best", "group_size")).alias("s"))
        return last.select("digest", *self._kept(F.col("s.best")), F.col("s.group_size").alias("group_size"))

    @staticmethod
    def _kept(best: Column) -> list[Column]:
        return [F.when(best["known"], F.bitwise_not(best["low_id"])).alias("keep_id"), F.bitwise_not(best["low_batch"]).alias("keep_batch"), best["locator"].alias("keep_locator")]

    def result(self, batch: int | None = None) -> DataFrame:
        """A row for each row added, or added in that batch, dropped ones too; groups are those of all batches."""
        self._finish()
        rows = self.fingerprints()
        mine = F.lit(True) if batch is None else F.col("batch") == batch
        if not rows.head(1):
            return self._shape(rows.withColumns({"keep_id": F.col("doc_id"), "keep_batch": F.col("batch"), "keep_locator": F.col("locator"), "group_size": F.lit(1).cast("long")}))
        # written, so that the join's sides come straight from shuffles and a hot digest's rows can be split
        last = saved(self.state(), "exact-state")
        found = saved(rows.join(last, "digest"), "exact-found")
        done(last)
        unlike = self._unlike(found)
        if unlike is None:
            return self._shape(found.where(mine))
        # unequal texts under one digest are grouped again, by their full bytes
        again = saved(self._texts(found.join(unlike, "digest", "left_semi")), "exact-again")
        groups = again.groupBy("norm").agg(F.max(_best()).alias("best"), F.count("*").alias("group_size")).select("norm", *self._kept(F.col("best")), "group_size")
        apart = again.drop("keep_id", "keep_batch", "keep_locator", "group_size").join(groups, "norm")
        return self._shape(found.join(unlike, "digest", "left_anti").where(mine)).unionByName(self._shape(apart.where(mine)))

    def _texts(self, rows: DataFrame) -> DataFrame:
        """Adds norm to rows, read back through their locators."""
        tables = [r["content"] for r in self.fingerprints().select("content").distinct().collect()]  # at most one a batch
        texts = reduce(DataFrame.unionByName, (located(self.spark, t) for t in sorted(tables))).select("locator", normalised().alias("norm"))
        return rows.join(texts, "locator")

    def _unlike(self, found: DataFrame) -> DataFrame | None:
        """Digests whose texts are not all equal."""
        hits = self._texts(found.where("group_size > 1").select("locator", "digest"))
        unlike = saved(hits.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).where("a <> b").select("digest"), "exact-unlike")
        if unlike.head(1):
            return unlike
        done(unlike)
        return None

    @staticmethod
    def _shape(df: DataFrame) -> DataFrame:
        kept = (F.col("batch") == F.col("keep_batch")) & (F.col("locator") == F.col("keep_locator"))
        return df.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "digest", "batch", "locator", "keep_locator")


def dedup(spark: SparkSession, docs: DataFrame | str, path: str | None = None, **kinds) -> DataFrame:
    """Which documents stay when equal texts are one: doc_id, keep_id, group_size, kept, text_sha256, digest and locators.

    docs: a DataFrame or the path of a Parquet table, as add() takes them. Texts are equal when they are so without
    [\\x20\\x09-\\x0D]. The longest original stays (code points), then the smallest doc_id; a null doc_id comes last. A
    null text counts as empty, and all empty texts are equal. Of rows that repeat a doc_id and text, one is kept. An
    empty table gives an empty result. Other columns of docs are ignored. With a path, the state in that folder lasts and
    groups take in what it holds; without, it goes once the result is written.
    """
    state = ExactDedup(spark, path, **kinds)
    batch = state.add(docs)
    out = saved(state.result(batch), "exact")
    if path is None:
        remove(spark, state.path)
    return out


def deduplicated(docs: DataFrame, **kinds) -> DataFrame:
    """The rows of docs that stay, whole, with all their columns, whatever these are called.

    Rules are those of dedup(): null texts are one group of empty ones, a null doc_id may stay if its text stands alone,
    of repeated rows one stays, an empty table gives an empty result. Rows are written once, with their places as keys,
    and move once, to meet the keys of those that stay.
    """
    spark = docs.sparkSession
    state = ExactDedup(spark, **kinds)
    batch = state.add(docs)
    stay = saved(state.result(batch).where("kept").select("locator"), "exact-stay")
    rows = located(spark, f"{state.path}/content-{batch:09d}", F.struct(*docs.columns).alias("r")).select("locator", "r")
    return rows.join(stay, "locator", "left_semi").select("r.*")
