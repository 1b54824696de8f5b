"""Rejected rows and error reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rule code -> (severity, retry class)
CODES = {"INVALID_HEX": ("error", "never"), "INVALID_BLOCK_FORMAT": ("error", "never"), "INVALID_INPUT_FORMAT": ("error", "never"), "PARSING_FAILED": ("error", "never"), "NOT_FOUND": ("warning", "later"), "ALREADY_EXISTS": ("info", "never"), "CONFLICT": ("warning", "at once"), "UNSUPPORTED_TX_TYPE": ("warning", "never"), "OTHER": ("error", "later")}


def _of(code: Column, i: int) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for k, v in CODES.items() for x in (k, v[i]))), code)


def split(df: DataFrame, rules: Mapping[str, Column], component: str, operation: str, block: Column, tx: Column, **more: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that no rule meets, and rejects with the code of the first rule met; a rule that is NULL is not met.

    more: further columns of the rejects, as the raw line.
    """
    code = F.coalesce(*(F.when(c, F.lit(k)) for k, c in rules.items()))
    marked = df.withColumn("_code", code)
    bad = marked.where("_code is not null").select(F.col("_code").alias("code"), _of(F.col("_code"), 0).alias("severity"), _of(F.col("_code"), 1).alias("retry"), F.lit(component).alias("component"), F.lit(operation).alias("operation"), block.cast("string").alias("block"), tx.cast("string").alias("tx"), *(c.alias(k) for k, c in more.items()))
    return marked.where("_code is null").drop("_code"), bad


def classify(message: Column) -> Column:
    m = F.lower(message)
    return F.when(m.contains("not found"), "NOT_FOUND").when(m.contains("already exists"), "ALREADY_EXISTS").when(m.contains("conflict"), "CONFLICT").when(m.contains("transaction type not supported"), "UNSUPPORTED_TX_TYPE").otherwise("OTHER")


def summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("code", "severity", "retry").agg(F.count("*").alias("n"))
