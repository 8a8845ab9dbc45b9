"""Corpus preparation: each stage works on all that its predecessor kept.

Stages take (spark, docs, sf_dir) and return the columns of documents; the last returns the copies
that a training run reads, in order of position. Between stages, documents are written to the
folder that executors share, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hemline.llm import decontamination, jaccard_join, language_id, mixing, suffix_dedup
from hemline.llm.common import keep


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in none of the languages learned from their labels, go."""
    return language_id.in_known_language(docs, language_id.learn(docs))


def one_of_near_duplicates(
    spark: SparkSession, docs: DataFrame, sf_dir: str, words: int = 5, percent: int = 80,
) -> DataFrame:
    """One document of each group of linked documents stays; ``words`` and ``percent`` say what links."""
    return jaccard_join.one_of_each_group(docs, words=words, percent=percent)


def repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that occur more than once are cut out of the texts."""
    return suffix_dedup.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, copy, position and take of every copy that training reads."""
    return mixing.manifest(mixing.plan(docs))


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_near_duplicates),
    ("suffix_dedup", repeats_removed),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: Automata, suffix sorting and connected groups have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
