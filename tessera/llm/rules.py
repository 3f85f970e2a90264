"""Quality rules: base counts, and the divergence of a text from references of its language.

A reference holds two histograms of one language: classes of characters, and its most common words
with all other words as one more bin. A text is compared by Jensen-Shannon distance (base 2, so 0
to 1) with every reference; the one with the nearest words counts. A histogram of few
words is far from its language by chance, so from each squared distance a part is taken that shrinks with the
number of words, and what is left is held against a limit from the quartiles of the whole corpus. Texts under a
minimum length are not held against it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.llm.support import give_back, map_arrow, only
from tessera.session import written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MARKS = ".,;:!?'\"()-"  # taken off both ends of a word before it is looked up
CLASSES = ("lower", "upper", "other letter", "digit", "white space", "mark", "symbol", "other")
COMMON = 100
#: Of characters and words: the part of a squared distance that chance may give one word; how many times the upper quartile's way
#: from the median a text may be above the median; and what quartiles of one text could be off, which shrinks with the square
#: root of the number of texts.
CHANCE = (3.0, 8.0)
SPREADS = (5.0, 8.0)
QUARTILE_ERROR = (0.25, 1.0)
MIN_CHARS, MIN_WORDS = 300, 60  # shorter texts are not held against the limit of characters, of words


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text holds twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    kinds = len(numbers)
    pairs = codes[:-1] * kinds + codes[1:]
    if kinds > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * kinds + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    often = np.zeros(len(windows), bool)
    often[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    inside = np.zeros(len(codes), bool)
    for shift in range(3):
        inside[shift:len(windows) + shift] |= often
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, twice = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            twice += line in seen
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), twice, repeated_words(words))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    def kind(c: str) -> int:
        return (4 if c.isspace() else 5 if c in MARKS else 6 if c in SYMBOLS else 3 if c.isdigit() else 0 if c.islower()
                else 1 if c.isupper() else 2 if c.isalpha() else 7)
    return np.fromiter((kind(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)


def character_histogram(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(classes()[points], minlength=len(CLASSES))


def plain_words(text: str) -> list[str]:
    return [w.strip(MARKS) for w in text.lower().split()]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 1 if exactly one is empty, 0 if both are."""
    if not p.sum() or not q.sum():
        return float(bool(p.sum()) != bool(q.sum()))
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    halves = [(x[x > 0] * np.log2(x[x > 0] / middle[x > 0])).sum() / 2 for x in (p, q)]
    return float(np.sqrt(min(max(sum(halves), 0.0), 1.0)))


class Reference:
    """One language's character classes, and its common words with their counts and that of all others."""

    def __init__(self, characters: np.ndarray, words: dict[str, int], others: int):
        self.characters = characters
        self.place = {w: i for i, w in enumerate(words)}
        self.words = np.array([*words.values(), others], float)

    def distances(self, characters: np.ndarray, words: Counter) -> tuple[float, float]:
        mine = np.zeros(len(self.words))
        for word in self.place.keys() & words.keys():
            mine[self.place[word]] = words[word]
        mine[-1] = words.total() - mine.sum()
        return js_distance(characters.astype(float), self.characters), js_distance(mine, self.words)


def references(docs: DataFrame, common: int = COMMON, text_column: str = "text", lang_column: str = "lang") -> dict[str, Reference]:
    """The references of all languages, from every row with text and language that passes the base rule.

    Words are counted inside tasks first; the driver gets ``common + 2`` rows per language.
    """
    source = only(docs, text=text_column, lang=lang_column).filter("text is not null and lang is not null")

    def work(batch: pa.RecordBatch) -> dict:
        words, characters = defaultdict(Counter), defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            raw = text.encode("utf-8", "surrogatepass").split()
            if base_failed(len(raw), repeated_words(raw)):
                continue
            words[lang].update(plain_words(text))
            characters[lang] += character_histogram(text)
        rows = [(lang, "w", w, n) for lang, c in words.items() for w, n in c.items()]
        rows += [(lang, "c", str(i), int(n)) for lang, h in characters.items() for i, n in enumerate(h)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        return {name: list(c) for name, c in zip(("lang", "kind", "item", "n"), columns)}

    totals = written(
        map_arrow(source, work, "lang string, kind string, item string, n long")
        .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), "counts")
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "item"))
    top = totals.filter("kind = 'w'").withColumn("place", place).filter(F.col("place") <= common).drop("place")
    rest = totals.filter("kind = 'w'").groupBy("lang").agg(F.sum("n").alias("n"))
    words, others, characters = defaultdict(dict), {}, defaultdict(lambda: np.zeros(len(CLASSES)))
    for row in top.orderBy("lang", F.desc("n"), "item").collect():
        words[row.lang][row.item] = row.n
    for row in rest.collect():
        others[row.lang] = row.n - sum(words[row.lang].values())
    for row in totals.filter("kind = 'c'").collect():
        characters[row.lang][int(row.item)] = row.n
    return {lang: Reference(characters[lang], words[lang], others[lang]) for lang in sorted(words)}


def judged(text: str | None, known: dict[str, Reference]) -> tuple:
    """The base counts, whether they fail, and the distances to the reference with the nearest words, 0 and 0 without any."""
    text = text or ""
    counts = base_counts(text)
    characters, words = character_histogram(text), Counter(plain_words(text))
    found = [r.distances(characters, words) for r in known.values()]
    return (*counts, base_failed(counts[0], counts[4]), *min(found, key=lambda d: (d[1], d[0]), default=(0.0, 0.0)))


def excesses(n_words: Column, char_distance: Column, word_distance: Column) -> list[Column]:
    """Squared distances without the part that chance may give a text of so many words."""
    return [d * d - F.lit(chance) / F.greatest(n_words, F.lit(1)) for d, chance in zip((char_distance, word_distance), CHANCE)]


def corpus_limits(measures: list[Column], rows: DataFrame) -> tuple[float, float]:
    """Limits of both excesses from the quartiles over all ``rows`` that pass the base rule, however many there are."""
    found = excesses(*measures[:3])
    row = rows.filter(~measures[3]).agg(F.count("*"), *[F.percentile_approx(e, [0.5, 0.75], 10_000) for e in found]).first()
    if not row[0]:
        return (0.0, 0.0)  # no text to be judged
    return tuple(half + k * (upper - half) + error / row[0] ** 0.5
                 for (half, upper), k, error in zip(row[1:], SPREADS, QUARTILE_ERROR))


def verdict(measures: list[Column], limits: tuple[float, float]) -> Column:
    """Passes the base rule, and is within both limits or too short for them."""
    n_words, _, _, failed, n_chars = measures
    near = [(e <= limit) | (n < least) for e, limit, n, least in zip(
        excesses(*measures[:3]), limits, (n_chars, n_words), (MIN_CHARS, MIN_WORDS))]
    return ~failed & near[0] & near[1]


def measured(docs: DataFrame, known: dict[str, Reference]) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and both distances for every row."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance")

    def work(batch: pa.RecordBatch) -> dict:
        found = list(zip(*[judged(text, known) for text in batch["text"].to_pylist()])) or [()] * len(names)
        return {"doc_id": batch["doc_id"], **{name: list(c) for name, c in zip(names, found)}}

    return map_arrow(
        only(docs, doc_id="doc_id", text="text"), work,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, char_distance double, word_distance double")


def judge_corpus(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, both distances and ``kept`` for every row.

    References and limits come from ``docs`` themselves. A null text counts as an empty one and so fails the base rule.
    Without references nothing but the base rule decides.
    """
    rows = written(measured(docs, references(docs)), "judged")
    measures = _measures(rows)
    return rows.withColumn("kept", verdict(measures, corpus_limits(measures, rows)))


def _measures(rows: DataFrame, within: str = "") -> list[Column]:
    """Words, distances, whether the base rule fails, and code points in words."""
    return [F.col(within + name) for name in ("n_words", "char_distance", "word_distance", "base_failed", "word_chars")]


def passing(docs: DataFrame) -> DataFrame:
    """The rows, all columns, that the rules keep, by references and limits from ``docs`` themselves."""
    known = references(docs)

    def measures(texts):
        import pandas as pd

        found = [judged(text, known) for text in texts]
        give_back()
        return pd.DataFrame({"n_words": [f[0] for f in found], "word_chars": [f[1] for f in found],
                             "char_distance": [f[6] for f in found], "word_distance": [f[7] for f in found],
                             "base_failed": [f[5] for f in found]})

    made = F.pandas_udf(measures, "n_words long, word_chars long, char_distance double, word_distance double, base_failed boolean")
    rows = written(docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), made(docs["text"]).alias("measure")), "judged")
    found = _measures(rows, "measure.")
    return rows.filter(verdict(found, corpus_limits(found, rows))).select("row.*")
