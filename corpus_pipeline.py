"""The training-data pipeline: language, quality, near-duplicates, mixing, tokens.

Every stage reads what its predecessor wrote. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bytepairs, languages, mixing, rules, simhash
from tessera.llm.queries import DISTANCE, SHINGLE, vocabulary_file
from tessera.plans.registry import query
from tessera.session import load, written


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return languages.with_known_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rule or diverge from their language go."""
    return rules.passing(docs)


def first_of_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.without_near_duplicates(docs, shingle=SHINGLE, distance=DISTANCE)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of small sources are repeated; none is lost."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bytepairs.digests(docs, vocabulary_file())


STAGES = [
    ("language ID", known_language),
    ("quality rules", good_quality),
    ("SimHash near-dedup", first_of_duplicates),
    ("mixing", mixed_sources),
    ("BPE", encoded),
]

#: Neither the fingerprints nor the token ids can be stated in SQL; the tests hold the result against brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
