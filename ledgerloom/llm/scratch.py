"""Tables that a job writes once and reads again, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: folders that were handed out and not deleted since
_MADE: set[str] = set()


def folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir. Only where that is unset on a local master, a local folder stands in."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.add(path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet and reads it: cuts lineage, survives lost executors, and gives Spark true sizes."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes folders through the file system they lie in."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _MADE.discard(path)


def release(spark: SparkSession) -> None:
    """Deletes all scratch tables of this process that are left. For callers who have written all results they want."""
    remove(spark, *sorted(_MADE))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def done(*tables: DataFrame) -> None:
    """Deletes tables of saved() that nothing will read again."""
    for t in tables:
        remove(t.sparkSession, t.scratch_path)


def rows_with(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """Whole rows of docs whose doc_id (long) is among stay's one column; rows are packed, so no name of theirs matters."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_key"))
    return packed.join(stay.toDF("_stay"), F.col("_key").eqNullSafe(F.col("_stay")), "left_semi").select("_row.*")


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the time of one job, given with __ for each dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
