"""Token counts, ranked vocabularies, id sequences, TF-IDF and document frequencies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.functions.text import name_mentions
from tessera.operators.ordered import running
from tessera.operators.quantiles import percentiles
from tessera.session import written

BROADCAST_ROWS = 500_000
TASK_TOKENS = 500_000  # tokens of whole documents that a task takes apart


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint, given only after counting an already written table."""
    return F.broadcast(df) if df.count() <= rows else df


def unfolded(df: DataFrame, keep: Sequence[str], values: Column | str, name: str) -> DataFrame:
    """One row per array element.

    The outer form is filtered afterwards on purpose: for the inner form the optimizer adds a
    size check below, which would compute an expensive array once more per row.
    """
    return df.select(*keep, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def token_counts(df: DataFrame, document: str, tokens: str) -> DataFrame:
    """Occurrences of each token and the place where it first appears."""
    placed = df.select(F.col(document).alias("_d"), F.posexplode_outer(tokens).alias("_p", "token"))
    placed = placed.filter("token is not null")
    return placed.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_d", "_p")).alias("first"))


def vocabulary(df: DataFrame, document: str, tokens: str) -> DataFrame:
    """Tokens ranked from 1 by count, ties by first appearance."""
    counts = token_counts(df, document, tokens)
    return running(counts, [F.desc("n"), F.asc("first")], rank="rank").select("token", "n", "rank")


def length_distribution(df: DataFrame, document: str, tokens: str) -> DataFrame:
    """Longest document, its id (the smallest on ties) and high percentiles of the length."""
    sized = written(df.select(F.col(document).alias("id"), F.size(tokens).alias("length")), "lengths")
    high = percentiles(sized, ["length"], {"p90": 0.90, "p95": 0.95, "p99": 0.99})
    longest = sized.agg(F.max(F.struct("length", -F.col("id"))).alias("m"))
    return high.select(
        longest.select("m.length").scalar().alias("longest"),
        longest.select(-F.col("m.col2")).scalar().alias("longest_id"), "p90", "p95", "p99")


def coverage(counts: DataFrame) -> DataFrame:
    """Share of all occurrences covered by the most frequent tokens; ties by token."""
    scanned = running(counts.select("token", "n"), [F.desc("n"), F.asc("token")], rank="rank", sums={"covered": "n"})
    total = scanned.agg(F.max("covered")).scalar()
    return scanned.select("token", "n", "rank", "covered", (F.col("covered") / total).alias("covered_share"))


def coverage_cutoff(covered: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Number of tokens that covers each share."""
    entries = [
        F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("covered_share") >= s, F.col("rank"))).alias("words"))
        for s in shares
    ]
    return covered.agg(F.array(*entries).alias("_c")).select(F.inline("_c"))


def encode(df: DataFrame, document: str, tokens: str, ranked: DataFrame, num_words: int) -> DataFrame:
    """Token ids per document; 1 stands for words outside the vocabulary or its cap.

    Documents are placed by id before their tokens are looked up, so that folding them again needs no further shuffle.
    """
    known = written(ranked.filter(F.col("rank") + 1 < num_words).select("token", (F.col("rank") + 1).cast("int").alias("_id")), "vocabulary")
    placed = df.select(F.col(document).alias(document), F.col(tokens).alias("_tokens")).repartition(document)
    tokens_of = placed.select(document, F.posexplode_outer("_tokens").alias("_p", "token"))
    joined = tokens_of.join(small(known), "token", "left")
    entry = F.when(F.col("_p").isNotNull(), F.struct("_p", F.coalesce("_id", F.lit(1)).alias("_id")))
    return joined.groupBy(document).agg(F.array_sort(F.collect_list(entry)).alias("_e")).select(
        document, F.transform("_e", lambda e: e["_id"]).alias("ids"))


def padded(ids: Column, length: int) -> Column:
    """Exactly ``length`` ids: cut at the end, or filled up with 0 at the end."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(0), length)), 1, length)


def document_frequency(df: DataFrame, tokens: str) -> DataFrame:
    """Documents containing each token, and their share of all documents."""
    counts = unfolded(df, [], F.array_distinct(tokens), "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("documents"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select("token", "documents", (F.col("documents") / total).alias("share"))


def filter_extremes(
    frequency: DataFrame, min_documents: int, max_share: float, keep: int | None = None
) -> DataFrame:
    """Tokens in at least ``min_documents`` and at most ``max_share`` of the documents.

    ``keep`` retains only the most frequent ones, as the dictionary size.
    """
    kept = frequency.filter((F.col("documents") >= min_documents) & (F.col("share") <= max_share))
    if keep is None:
        return kept
    return running(kept, [F.desc("documents"), F.asc("token")], rank="_rank").filter(F.col("_rank") <= keep).drop("_rank")


def numbered(kept: DataFrame) -> DataFrame:
    """Token ids from 0 in alphabetical order."""
    return running(kept.select("token"), ["token"], rank="_rank").select(
        "token", (F.col("_rank") - 1).alias("token_id"))


def _term_counts(df: DataFrame, document: str, tokens: str, kept: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of a document's terms; ``df`` is read twice, so it should be a written table.

    Token arrays pack well and take ten times their shuffled size as rows, so the number of tasks follows from the number
    of tokens: each counts and sorts about ``TASK_TOKENS`` in memory.
    """
    amount = df.agg(F.sum(F.size(tokens))).first()[0] or 0
    width = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(amount / TASK_TOKENS))
    placed = df.select(document, F.col(tokens).alias("_tokens")).repartition(width, document)
    return unfolded(placed, [document], "_tokens", "token").join(small(kept), "token").groupBy(document, "token", *columns).agg(F.count(F.lit(1)).alias("n"))


def bag_of_words(df: DataFrame, document: str, tokens: str, kept: DataFrame) -> DataFrame:
    """(document, token id, count) of the dictionary's tokens."""
    ids = written(numbered(kept), "dictionary")
    return _term_counts(df, document, tokens, ids, ["token_id"]).select(document, "token_id", "n")


def tfidf(df: DataFrame, document: str, tokens: str, min_documents: int = 3, max_share: float = 0.3) -> DataFrame:
    """Smoothed TF-IDF with unit length per document, long form.

    ``idf = ln((1+n)/(1+df)) + 1`` and the raw count as ``tf``. Tokens are written once.
    """
    df = written(df.select(document, tokens), "tokens")
    kept = filter_extremes(document_frequency(df, tokens), min_documents, max_share)
    total = df.agg(F.count(F.lit(1))).scalar()
    idf = (F.log((1 + total) / (1 + F.col("documents"))) + 1).alias("idf")
    terms = written(kept.select("token", idf), "terms")
    weighted = _term_counts(df, document, tokens, terms, ["idf"]).withColumn("raw", F.col("n") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(document)))  # terms of one document
    return weighted.select(document, "token", "n", (F.col("raw") / length).alias("weight"))


def mentions(df: DataFrame, document: str, text: str) -> DataFrame:
    return unfolded(df, [document], name_mentions(F.col(text)), "mention")


def mention_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("mention").agg(F.count(F.lit(1)).alias("n"))


def plural_lemmas(words: DataFrame) -> DataFrame:
    """``word, lemma`` by rule, for want of a dictionary: a token with a final s whose form without it occurs as well."""
    ending = words.filter(F.col("token").endswith("s") & (F.length("token") > 3)).select(
        F.col("token").alias("word"), F.expr("left(token, length(token) - 1)").alias("lemma"))
    return ending.join(words.select(F.col("token").alias("lemma")).distinct(), "lemma", "left_semi").select("word", "lemma").distinct()


def lemmatised(df: DataFrame, document: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """``document, tokens`` with the words of a dictionary (``word, lemma``, a word once) replaced by their lemmas.

    Stop words are to be taken out afterwards. The dictionary is joined to the tokens; Spark broadcasts it if it is small.
    """
    placed = df.select(document, F.col(tokens).alias("_tokens")).repartition(document)
    words = placed.select(document, F.posexplode_outer("_tokens").alias("_p", "word"))
    entry = F.when(F.col("_p").isNotNull(), F.struct("_p", F.coalesce("lemma", "word").alias("_w")))
    return words.join(lemmas, "word", "left").groupBy(document).agg(F.array_sort(F.collect_list(entry)).alias("_e")).select(
        document, F.transform("_e", lambda e: e["_w"]).alias(tokens))
