"""From raw documents to packed training sequences: language, exact and near copies, mix of the sources, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from tallyframe.llm.queries import PATTERN, RANKS, VOCABULARY
from tallyframe.llm.shared import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without letters or like none of the languages go."""
    return language_id.recognised(docs, language_id.profiles(docs.where(~language_id.held_out("doc_id"))))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.harmonic_pack(docs, VOCABULARY, RANKS, PATTERN)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mix_sources", mix_sources), ("pack", pack)]

# No SQL: n-gram ranks, exponential tilts and subword ids are beyond it. The tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
