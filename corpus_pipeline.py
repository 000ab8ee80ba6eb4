"""The corpus pipeline: quality rules, near duplicates, benchmark passages, mixing and shards, one stage after another.

Each stage takes all that the one before it kept, written as Parquet and read again, and each decision takes effect: rows
that a stage leaves out are not seen by the later ones. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import decontamination, jaccard_join, mixing, quality_rules, sharding
from recordloom.llm.queries import SHARDS, shipped
from recordloom.llm.tables import table, written

#: Words of an n-gram, and the similarity in per cent, that make near duplicates.
GRAM_WORDS, SIMILARITY = 5, 80
#: The version of the quality policy.
POLICY = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    return quality_rules.apply_policy(docs, POLICY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id."""
    return jaccard_join.one_of_each(docs, words_per_gram=GRAM_WORDS, percent=SIMILARITY)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    return sharding.shard(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", shipped(quality)),
    ("ngram_jaccard_join", shipped(near_duplicates)),
    ("benchmark_decontamination", shipped(benchmark_passages)),
    ("source_mixing", shipped(mixing_sources)),
    ("sharding", shipped(shards)),
]

#: SQL cannot express the seeded order of documents, the joined components or the aligned passages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before it kept, from the whole table of documents on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


