"""From raw documents to packed batches: language, copies, near copies, mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from watchledger.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from watchledger.llm.common import read_table, remainder, small_batches
from watchledger.workspace import new_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go: those without a letter, and those far from every profile.  Profiles and the least scores come from all labelled rows."""
    small_batches(spark)
    labelled = docs.where(remainder("doc_id", 4) != 2)
    profiles = language_id.learn_profiles(labelled, train_docs=None)
    return language_id.in_a_language(docs, profiles, language_id.score_floors(labelled, profiles))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    small_batches(spark)
    return exact_dedup.keep_winners(docs, exact_dedup.in_history())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    small_batches(spark)
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the target weights ask for."""
    small_batches(spark)
    return mixing.mix(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches."""
    small_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: Profiles learned from counts and a minimal perfect hash are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
