"""TF-IDF vectors and a linear classifier over a vocabulary that stays a table.

Term ids are ranks of a distributed dictionary, and vectors are assembled by joining tokens to it, so no task and no
driver holds the terms. Of a fitted model the driver has a few numbers per term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tessera.operators import logistic
from tessera.operators.ordered import running
from tessera.operators.vocabulary import TASK_TOKENS, document_frequency, filter_extremes, small, unfolded
from tessera.session import fresh_path, written

#: How Spark stores a sparse vector.
SPARSE = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


class Terms:
    """``table`` has token, term_id (0 on, in alphabetical order), documents and idf; ``size`` terms from ``documents`` rows."""

    def __init__(self, table: DataFrame, size: int, documents: int):
        self.table, self.size, self.documents = table, size, documents

    @classmethod
    def fit(cls, df: DataFrame, tokens: str, min_documents: int = 3, max_share: float = 0.3) -> Terms:
        """All terms within the limits, with ``idf = ln((1 + n) / (1 + documents)) + 1``."""
        total = df.count()
        kept = filter_extremes(document_frequency(df, tokens), min_documents, max_share).select("token", "documents")
        idf = F.log((1 + F.lit(total)) / (1 + F.col("documents"))) + 1
        table = written(running(kept, ["token"], rank="_rank").select(
            "token", (F.col("_rank") - 1).cast("int").alias("term_id"), "documents", idf.alias("idf")), "terms")
        return cls(table, table.count(), total)

    def weighted(self, df: DataFrame, document: str, tokens: str) -> DataFrame:
        """``document, term_id, raw`` (occurrences times idf) for every known term of a document.

        A task counts about ``TASK_TOKENS``; ``df`` is read twice, so it should be a written table.
        """
        amount = df.agg(F.sum(F.size(tokens))).first()[0] or 0
        width = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(amount / TASK_TOKENS))
        placed = df.select(document, F.col(tokens).alias("_tokens")).repartition(width, document)
        known = small(self.table.select("token", "term_id", "idf"))
        found = unfolded(placed, [document], "_tokens", "token").join(known, "token")
        return found.groupBy(document, "term_id").agg((F.count(F.lit(1)) * F.first("idf")).alias("raw"))

    def vectors(self, df: DataFrame, document: str, tokens: str, keep: Sequence[str] = ()) -> DataFrame:
        """``document, keep..., features``: sparse vectors of unit length, empty for a document without a known term.

        A document's terms are put together in the task that holds the document.
        """
        rows, path = self._rows(df, document, tokens, keep)
        fields = [f for f in rows.schema if f.name != "features"]
        return df.sparkSession.read.schema(StructType([*fields, StructField("features", VectorUDT())])).parquet(path)

    def _rows(self, df: DataFrame, document: str, tokens: str, keep: Sequence[str] = ()) -> tuple[DataFrame, str]:
        """``vectors`` as they are stored, with the columns of ``SPARSE``, and the folder they were written to."""
        entry = F.struct("term_id", "raw")
        folded = self.weighted(df, document, tokens).groupBy(document).agg(
            F.array_sort(F.collect_list(entry)).alias("_e"), F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_length"))
        joined = df.select(document, *keep).join(folded, document, "left")
        none = F.array().cast("array<struct<term_id:int,raw:double>>")
        entries = F.coalesce("_e", none)
        sparse = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"),
            F.transform(entries, lambda e: e["term_id"]).alias("indices"),
            F.transform(entries, lambda e: e["raw"] / F.col("_length")).alias("values"))
        rows = joined.select(document, *keep, sparse.cast(SPARSE).alias("features"))
        path = fresh_path(df.sparkSession, "vectors")
        rows.write.parquet(path)
        return df.sparkSession.read.schema(rows.schema).parquet(path), path


class TermClassifier:
    """Logistic regression on the vectors of ``terms``."""

    def __init__(self, terms: Terms, model: logistic.Logistic, train: DataFrame | None = None, rows: DataFrame | None = None):
        self.terms, self.model = terms, model
        self._train, self._rows = train, rows  # what the model was fitted on, and its vectors

    @classmethod
    def fit(cls, train: DataFrame, document: str, tokens: str, label: str, max_iterations: int = 1000) -> TermClassifier:
        """The penalty on the weights, not the intercept, equals one over the number of training rows.

        Labels are 0 or 1; ``max_iterations`` bounds the passes over the rows.
        """
        terms = Terms.fit(train, tokens)
        if not terms.size:
            raise ValueError("no term is within the limits")
        known = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
        if not train.filter(~known).isEmpty():
            raise ValueError(f"{label} must be 0 or 1")
        rows, _ = terms._rows(train.withColumn(label, F.col(label).cast("double")), document, tokens, [label])
        return cls(terms, logistic.fit(rows, "features", label, terms.size, max_iterations), train, rows)

    def transform(self, df: DataFrame, document: str, tokens: str, keep: Sequence[str] = ()) -> DataFrame:
        """``document, keep..., score, predicted``."""
        rows, _ = self.terms._rows(df, document, tokens, keep)
        return self.model.score(rows, "features", "score").select(document, *keep, "score", (F.col("score") > 0.5).cast("int").alias("predicted"))

    def weights(self) -> DataFrame:
        """``token, term_id, documents, idf, weight``."""
        table = self.terms.table
        shared = table.sparkSession.sparkContext.broadcast(self.model.coefficients.toArray())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value[batch["term_id"].to_numpy()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "weight"])

        named = table.select("token", "term_id", "documents", "idf")
        return named.mapInArrow(work, named.withColumn("weight", F.lit(0.0)).schema)

    def slopes(self, train: DataFrame, document: str, tokens: str, label: str) -> DataFrame:
        """``token, documents, idf, weight, slope``: the derivative of the penalised mean loss by each weight.

        It is 0 at the optimum. Computed from scores and long-form weights, by joins, not by the solver. The vectors of the
        rows that the model was fitted on are made once.
        """
        rows = self._rows if train is self._train else self.terms._rows(train, document, tokens, [label])[0]
        scored = self.model.score(rows, "features", "score").select(
            (F.col("score") - F.col(label)).alias("_miss"), F.arrays_zip("features.indices", "features.values").alias("_e"))
        entries = scored.select("_miss", F.explode("_e").alias("_e")).select(
            F.col("_e.indices").alias("term_id"), (F.col("_e.values") * F.col("_miss")).alias("_part"))
        pulled = entries.groupBy("term_id").agg(F.sum("_part").alias("_pull"))
        return self.weights().join(pulled, "term_id").select(
            "token", "documents", "idf", "weight", ((F.col("_pull") + F.col("weight")) / self.terms.documents).alias("slope"))
