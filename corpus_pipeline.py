"""Raw documents to token ids: language, exact copies, near copies, mixture, tokens.

Every stage takes and returns whole rows with all their columns, whatever these are called; the last returns tokens. An
empty table gives an empty result in each stage, and texts of any length are read whole. Equal results for equal input,
however its rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from ledgerloom.llm.queries import vocabulary
from ledgerloom.llm.scratch import saved

#: A pair at 0.80 has fewer than 75 of 128 equal coordinates with probability 9e-9; about 5e-4 of such pairs are lost by
#: all trees, at any depth (tests/llm has the recall by depth).
NEAR = near_dedup.Plan(percent=80, agree=75, trees=14)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language, those with an empty or null text among them.

    Rows that repeat a doc_id all stay if one does; null doc_ids count as one such id.
    """
    return language_id.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of equal texts: the longest original, then the smallest doc_id, a null one last.

    A null text counts as empty, and empty texts are equal; of repeated rows one stays.
    """
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: five words, a similarity of 0.8 or more.

    The smallest doc_id of a group stays, with all rows that repeat it; empty or null texts and null doc_ids stay.
    """
    return near_dedup.deduplicated(docs, NEAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples half of the tokens, to tempered shares of the sources, languages and topics that are there.

    A row without words is kept or not by its cell like any other; null sources and languages are a value of their own;
    rows with equal doc_id and text share their fate.
    """
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded text, a row for each row.

    An empty or null text has no ids; null doc_ids and repeated rows pass through.
    """
    return bpe.tokenized(docs, vocabulary())


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("bpe", tokens)]

#: A trained language model and a hash lottery have no SQL twin; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
