"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters inside blank-bounded words, letters
only, lower case) in order of frequency. A document gets the language whose profile its own
profile is least out of place with: per n-gram the difference of ranks, the full profile length
if the language does not list it.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.llm.support import give_back, map_arrow, only
from tessera.session import written

WIDTH = 21  # bits of a character
PROFILE = 400
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as integers; empty if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = letters()[points]
    if not inside.any():
        return np.zeros(0, np.int64)
    marked = np.where(inside, points + 1, 1).astype(np.int64)  # 1 is the blank
    marked = np.concatenate([[1], marked, [1]])
    blank = marked == 1
    marked = marked[~(blank & np.concatenate([[False], blank[:-1]]))]
    first, second, third = marked[:-2], marked[1:-1], marked[2:]
    pairs = (marked[:-1] << WIDTH) | marked[1:]
    triples = ((first << (2 * WIDTH)) | (second << WIDTH) | third)[second != 1]
    return np.concatenate([marked[marked != 1], pairs, triples])


def counted(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(codes, return_counts=True)
    values, place = np.unique(codes, return_inverse=True)
    return values, np.bincount(place, weights=counts, minlength=len(values)).astype(np.int64)


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, the smaller code first among equals."""
    values, counts = counted(codes)
    return values[np.lexsort((values, -counts))[:size]]


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; a row without an id is neither held out nor learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def profiles(docs: DataFrame, size: int = PROFILE, id_column: str = "doc_id", text_column: str = "text",
             lang_column: str = "lang", piece: int = 1 << 20) -> dict[str, np.ndarray]:
    """The profile of every language, learned from all rows that have text and language and are not held out.

    N-grams are summed inside tasks first; the driver gets ``size`` rows per language.
    """
    source = only(docs, doc_id=id_column, text=text_column, lang=lang_column)
    source = source.filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())

    def work(batch: pa.RecordBatch) -> dict:
        waiting, summed = defaultdict(list), defaultdict(list)

        def settle(lang: str) -> None:
            summed[lang].append(counted(np.concatenate(waiting.pop(lang))))
            if len(summed[lang]) > 8:
                summed[lang] = [counted(*map(np.concatenate, zip(*summed[lang])))]

        held = defaultdict(int)
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            waiting[lang].append(grams(text))
            held[lang] += len(waiting[lang][-1])
            if held[lang] > piece:
                settle(lang)
                held[lang] = 0
        for lang in list(waiting):
            settle(lang)
        parts = {lang: counted(*map(np.concatenate, zip(*s))) for lang, s in summed.items()}
        return {"lang": [lang for lang, (v, _) in parts.items() for _ in range(len(v))],
                "gram": np.concatenate([v for v, _ in parts.values()] or [np.zeros(0, np.int64)]),
                "n": np.concatenate([n for _, n in parts.values()] or [np.zeros(0, np.int64)])}

    totals = map_arrow(source.select("lang", "text"), work, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = written(totals.withColumn("place", place).filter(F.col("place") <= size).select("lang", "gram", "place"), "profiles")
    found: dict[str, list] = defaultdict(list)
    for row in top.orderBy("lang", "place").toLocalIterator():
        found[row.lang].append(row.gram)
    return {lang: np.array(codes, np.int64) for lang, codes in found.items()}


class Judge:
    """Distances of texts to a fixed set of profiles."""

    def __init__(self, learned: dict[str, np.ndarray], size: int):
        self.size, self.langs = size, sorted(learned)
        self.codes = {lang: np.sort(learned[lang]) for lang in self.langs}
        self.ranks = {lang: np.argsort(learned[lang], kind="stable") for lang in self.langs}

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The nearest language, the first by name among equals, and how far from wholly out of place it is."""
        mine = ranked(grams(text or ""), self.size)
        if not len(mine) or not self.langs:
            return UNKNOWN, 0.0
        at, best = np.arange(len(mine)), None
        for lang in self.langs:
            codes, ranks = self.codes[lang], self.ranks[lang]
            spot = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
            out = np.where(codes[spot] == mine, np.minimum(np.abs(ranks[spot] - at), self.size), self.size)
            distance = int(out.sum()) / (len(mine) * self.size)
            if best is None or distance < best[1]:
                best = lang, distance
        return best[0], 1.0 - best[1]


def predict(docs: DataFrame, learned: dict[str, np.ndarray], size: int = PROFILE,
            id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, lang_pred, score`` per row; only the text counts.

    ``und`` with score 0 for a null text, a text without a letter, or when nothing was learned.
    ``digest`` is a hash of the text that tells rows of one id apart.
    """
    source = only(docs, doc_id=id_column, text=text_column).withColumn("digest", F.xxhash64("text"))
    judge = Judge(learned, size)

    def work(batch: pa.RecordBatch) -> dict:
        found = [judge(text) for text in batch["text"].to_pylist()]
        return {"doc_id": batch["doc_id"], "digest": batch["digest"],
                "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64())}

    return map_arrow(source, work, "doc_id long, digest long, lang_pred string, score double")


def identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Learn from ``docs`` and predict all its rows: ``doc_id, held_out, lang_pred, score``."""
    return predict(docs, profiles(docs, size), size).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def with_known_language(docs: DataFrame, size: int = PROFILE, share: float = 0.5) -> DataFrame:
    """The rows, all columns, whose text has a language: not ``und``, and a score of ``share`` of the usual one or more.

    The usual score is the median over the rows that were learned from, whatever their number. Every text is scored once; rows
    go to the shared folder with their scores, since the median is known only after all of them. Letters at random and
    texts in other languages of the same script score about a third of the usual score.
    """
    judge = Judge(profiles(docs, size), size)

    def scored(texts):
        import pandas as pd

        found = [score if lang != UNKNOWN else None for lang, score in map(judge, texts)]
        give_back()
        return pd.Series(found, dtype="float64")

    learned = F.coalesce(~held_out(docs["doc_id"]) & docs["lang"].isNotNull(), F.lit(False))
    rows = written(docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), learned.alias("learned"),
                               F.pandas_udf(scored, "double")(docs["text"]).alias("score")), "scored")
    usual = rows.filter("learned").agg(F.percentile_approx("score", 0.5, 10_000)).first()[0]
    return rows.filter(F.col("score") >= F.lit(share * (usual or 0.0))).select("row.*")
