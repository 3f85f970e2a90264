"""Topic models, their leading terms and the distances between topics."""

from __future__ import annotations

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import DataFrame, functions as F


def fit_topics(
    df: DataFrame, tokens: str, topics: int, passes: int = 10, min_documents: float = 3, max_share: float = 0.25,
    vocabulary_size: int = 100_000, seed: int = 42,
) -> tuple[CountVectorizerModel, LDAModel]:
    """Topics over the ``vocabulary_size`` most frequent terms, as large as the studied dictionary may grow."""
    counter = CountVectorizer(
        inputCol=tokens, outputCol="features", minDF=min_documents, maxDF=max_share, vocabSize=vocabulary_size).fit(df)
    counts = counter.transform(df).select("features").persist()
    try:
        model = LDA(k=topics, maxIter=passes, optimizer="online", seed=seed).fit(counts)
    finally:
        counts.unpersist()
    return counter, model


def leading_terms(counter: CountVectorizerModel, model: LDAModel, terms: int = 10) -> DataFrame:
    """(topic, position, term, weight) of the heaviest terms of each topic."""
    spark = model.describeTopics(1).sparkSession
    names = spark.createDataFrame(list(enumerate(counter.vocabulary)), "termIndex int, term string")
    described = model.describeTopics(terms).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("position", "_t"))
    flat = described.select("topic", "position", F.col("_t.termIndices").alias("termIndex"), F.col("_t.termWeights").alias("weight"))
    return flat.join(names, "termIndex").select("topic", "position", "term", "weight")


def topic_vectors(model: LDAModel) -> DataFrame:
    """(vector, term, weight) rows of the topic-term matrix; its size is terms x topics."""
    topics = model.describeTopics(model.vocabSize())
    return topics.select(F.col("topic").alias("vector"), F.inline(F.arrays_zip(
        F.col("termIndices").alias("term"), F.col("termWeights").alias("weight"))))


def cosine_distances(vectors: DataFrame) -> DataFrame:
    """Distance of every pair of vectors, from (vector, term, weight) rows.

    Meant for a handful of vectors such as topics or class centres: the result has the square of their number
    of rows, never of the number of documents. The distance is null where a vector has no length.
    """
    norms = vectors.groupBy("vector").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    left = vectors.select(F.col("vector").alias("first"), "term", F.col("weight").alias("_a"))
    right = vectors.select(F.col("vector").alias("second"), "term", F.col("weight").alias("_b"))
    dots = left.join(right, "term").filter("first < second").groupBy("first", "second").agg(
        F.sum(F.col("_a") * F.col("_b")).alias("_dot"))
    # Vectors that share no term have a product of 0 and still are a pair.
    names = norms.agg(F.array_sort(F.collect_list(F.struct("vector", "norm"))).alias("all"))
    pairs = names.select("all", F.posexplode("all").alias("at", "a")).select(
        "a", F.explode(F.slice("all", F.col("at") + 2, F.size("all"))).alias("b"))
    pairs = pairs.select(F.col("a.vector").alias("first"), F.col("b.vector").alias("second"), (F.col("a.norm") * F.col("b.norm")).alias("_norms"))
    cosine = F.try_divide(F.coalesce("_dot", F.lit(0.0)), F.col("_norms"))
    return pairs.join(dots, ["first", "second"], "left").select("first", "second", (1 - cosine).alias("distance"))


def mean_distance(vectors: DataFrame) -> DataFrame:
    return cosine_distances(vectors).agg(F.avg("distance").alias("mean_distance"))


def centroids(df: DataFrame, label: str, values: str) -> DataFrame:
    """Mean of an array column per label, as (vector, term, weight) rows."""
    return df.select(F.col(label).alias("vector"), F.posexplode(values).alias("term", "_v")).groupBy("vector", "term").agg(
        F.avg(F.col("_v").cast("double")).alias("weight"))
