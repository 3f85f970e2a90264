"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    audits, bytepairs, chats, languages, licences, masked, mixing, periodic, rules, secret_scan, simhash, tokenfiles, vectors)
from tessera.plans.registry import query
from tessera.session import load

COSINE = 0.98
SHINGLE, DISTANCE = 3, 3

COSINE_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM v
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN least c ON v.vec_id = c.a LEFT JOIN degree d ON v.vec_id = d.a
"""


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_embedding_near_duplicates", COSINE_SQL)
def embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(load(spark, folder, "embeddings"), least=COSINE)


@query("op2_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents"), shingle=SHINGLE, distance=DISTANCE)


@query("op3_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bytepairs.digests(load(spark, folder, "documents"), vocabulary_file())


@query("op4_language_profiles")
def language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identify(load(spark, folder, "documents"))


@query("op5_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge_corpus(load(spark, folder, "documents"))


@query("op6_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.round_trip(load(spark, folder, "documents"), vocabulary_file(), end_id=0)


@query("op7_chat_format", chats.SQL)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chats.formatted(load(spark, folder, "conversations"))


@query("op8_licence_digests", licences.sql())
def licence_digests(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(load(spark, folder, "documents"))


@query("op9_temperature_mixing")
def temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(load(spark, folder, "documents"))


@query("op10_masked_scores")
def masked_scores(spark: SparkSession, folder: str) -> DataFrame:
    return masked.fit_and_score(load(spark, folder, "documents"))


@query("op11_filter_interactions", audits.SQL)
def filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return audits.interactions(load(spark, folder, "documents"), load(spark, folder, "labels"))


@query("op12_secret_scan")
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(load(spark, folder, "documents"))


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digests(load(spark, folder, "documents"))
