"""Masked pseudo-likelihood: a small network predicts every token of a text from the tokens on both sides.

Tokens are the lower-case words of a text without sentence marks. Words above a relative frequency have numbers of
their own, all others share numbers by hash. The network adds up one embedding per place of the window, applies
tanh, and gives a distribution over groups of numbers and one over the numbers of each group. It is trained on every
document: each task goes through its rows with stochastic gradients from the common start, and the tasks' weights are
averaged by the number of their examples. The probability of a word is that of its number times the word's share in the
counts of that number. The score of a text is the sum of the logarithms of the probabilities of its tokens.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tessera.llm.support import map_arrow, only
from tessera.session import written

MARKS = b".,;:!?\"()"
REACH = 2  # tokens on either side
PAD = 0
NEVER = -1e4  # the logit of a member beyond the last number
BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))  # where ``bytes.split`` splits
BLOCK = 8 << 20  # characters of texts that are taken apart at once


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, MARKS).split()


def word_blocks(texts: list[str | None]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of all texts as they follow one another, with the number of words of each text, for a few texts at a time."""
    block, held = [], 0
    for text in texts:
        block.append(text or "")
        held += len(block[-1])
        if held >= BLOCK:
            yield _block(block)
            block, held = [], 0
    if block:
        yield _block(block)


def _block(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    plain = [t.lower().encode("utf-8", "surrogatepass").translate(None, MARKS) for t in texts]
    data = np.frombuffer(b" ".join([*plain, b""]), np.uint8)
    blank = BLANK[data]
    ends = np.flatnonzero(blank)
    lengths = np.diff(ends, prepend=-1) - 1
    real = lengths > 0  # no word ends at a blank after another
    offsets = np.zeros(np.count_nonzero(real) + 1, np.int64)
    np.cumsum(lengths[real], out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank])])
    last = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in plain]) - 1)
    return words, np.diff(np.cumsum(real)[last], prepend=0)


def distinct(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The different words, and where each word is among them."""
    coded = words.dictionary_encode()
    known = coded.dictionary
    # No word holds a blank, and splitting is several times faster than taking values one by one.
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(known)]), known), pa.scalar(b" ", known.type))
    return joined[0].as_py().split(), coded.indices.to_numpy()


class Vocabulary:
    """Numbers 1 to ``len(own)`` for frequent words, then ``shared`` numbers for all others; 0 is beyond the ends."""

    def __init__(self, own: list[bytes], shared: int):
        self.own = {w: i for i, w in enumerate(own, 1)}
        self.shared, self.first = shared, len(own) + 1
        self.size = self.first + shared

    def number(self, word: bytes) -> int:
        return self.own.get(word) or self.first + zlib.crc32(word) % self.shared

    def every(self, words: list[bytes]) -> np.ndarray:
        own, first, shared, crc = self.own.get, self.first, self.shared, zlib.crc32
        return np.array([own(w) or first + crc(w) % shared for w in words], np.int32)

    def numbers(self, text: str | None) -> np.ndarray:
        return self.lists([text]).values.to_numpy()

    def lists(self, texts: list[str | None]) -> pa.ListArray:
        """The numbers of every text."""
        found, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for words, counts in word_blocks(texts):
            different, at = distinct(words)
            found.append(self.every(different)[at])
            lengths.append(counts)
        return lists(np.concatenate(lengths), np.concatenate(found))


def lists(lengths: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    """Lists of these lengths that share out the values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts (``word`` in bytes), counted inside tasks first."""
    def work(batch: pa.RecordBatch) -> dict:
        blocks = [words for words, _ in word_blocks(batch["text"].to_pylist())]
        counts = pa.chunked_array(blocks, pa.large_binary()).value_counts()
        return {"word": counts.field("values"), "n": counts.field("counts")}

    return map_arrow(only(docs, text="text"), work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Network:
    """Weights as one vector, so that tasks can average them."""

    def __init__(self, size: int, hidden: int):
        self.groups = math.ceil(math.sqrt(size) / 2)
        self.members = math.ceil(size / self.groups)
        self.size = size
        # The last row of weights into logits is the bias. Number i is member i % members of group i // members.
        self.shapes = ((2 * REACH, size, hidden), (hidden,), (hidden + 1, self.groups), (self.groups, hidden + 1, self.members))
        self.length = sum(int(np.prod(s)) for s in self.shapes)

    def start(self, frequency: np.ndarray, seed: int) -> np.ndarray:
        """Small random weights; the biases of the logits are logarithms of frequencies, so it begins as the unigram model."""
        rng = np.random.default_rng(seed)
        parts = [rng.standard_normal(s) * 0.1 for s in self.shapes]
        places, bias, top, low = parts
        bias[:] = 0
        cells = np.zeros(self.groups * self.members)
        cells[:self.size] = frequency
        cells = cells.reshape(self.groups, self.members)
        top[-1] = np.log(np.maximum(cells.sum(axis=1), 1e-30))
        low[:, -1] = np.where(cells > 0, np.log(np.maximum(cells, 1e-30)), NEVER)
        return np.concatenate([p.ravel() for p in parts]).astype(np.float32)

    def split(self, weights: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for shape in self.shapes:
            n = int(np.prod(shape))
            out.append(weights[at:at + n].reshape(shape))
            at += n
        return out

    def hidden(self, parts: list[np.ndarray], around: np.ndarray) -> np.ndarray:
        """Hidden values, one column per row of numbers around the hidden token, and a last row of 1 for the bias."""
        places, bias = parts[:2]
        sums = places[0].take(around[:, 0], axis=0)
        for k in range(1, around.shape[1]):
            sums += places[k].take(around[:, k], axis=0)
        sums += bias
        out = np.ones((len(bias) + 1, len(sums)), bias.dtype)
        out[:-1] = np.tanh(sums, out=sums).T
        return out

    def runs(self, token: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The order of rows by the group of their token, and (group, first, end) of each group's run."""
        group = token // self.members
        order = np.argsort(group.astype(np.int16), kind="stable")  # few enough groups for sorting by digits
        ends = np.cumsum(np.bincount(group, minlength=self.groups)).tolist()
        return order, [(g, a, b) for g, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]

    def logits(self, parts: list[np.ndarray], hidden: np.ndarray,
               runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the groups and of the members of the token's group, less the largest, one column per row in runs."""
        top, low = parts[-2:]
        members = np.empty((self.members, hidden.shape[1]), hidden.dtype)
        for group, a, b in runs:
            np.matmul(low[group].T, hidden[:, a:b], out=members[:, a:b])
        groups = top.T @ hidden
        for logits in (groups, members):
            logits -= logits.max(axis=0)
        return groups, members

    def logs(self, parts: list[np.ndarray], around: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The log-probability of every token."""
        order, runs = self.runs(token)
        token, rows, found = token[order], np.arange(len(token)), 0
        both = self.logits(parts, self.hidden(parts, around[order]), runs)
        for logits, wanted in zip(both, (token // self.members, token % self.members)):
            at = logits[wanted, rows]
            np.exp(logits, out=logits)
            found = found + at - np.log(logits.sum(axis=0))
        out = np.empty(len(token))
        out[order] = found
        return out

    def forward(self, parts: list[np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and the log-probabilities of all numbers."""
        hidden = self.hidden(parts, around).T
        both = [hidden @ parts[2], np.einsum("nh,ghm->ngm", hidden, parts[3])]
        for logits in both:
            logits -= logits.max(axis=-1, keepdims=True)
            logits -= np.log(np.exp(logits).sum(axis=-1, keepdims=True))
        return hidden[:, :-1], (both[0][:, :, None] + both[1]).reshape(len(hidden), -1)[:, :self.size]

    def train(self, weights: np.ndarray, batches: Iterator[tuple[np.ndarray, np.ndarray]], rate: float) -> int:
        """Adam steps on batches of (around, token), in place; the number of examples."""
        first, second, scale = np.zeros_like(weights), np.zeros_like(weights), np.empty_like(weights)
        gradient, seen, steps = np.zeros_like(weights), 0, 0
        parts, slopes = self.split(weights), self.split(gradient)
        places, bias, top, low = parts
        kinds, size, width = places.shape
        lows, low_slopes = list(low[:, :-1]), list(slopes[3])
        value, cells = np.arange(width)[:, None], np.empty((kinds, width, 0), np.int64)
        for around, token in batches:
            n, steps = len(token), steps + 1
            order, runs = self.runs(token)
            around, token, rows = around.take(order, axis=0), token.take(order), np.arange(n)
            hidden = self.hidden(parts, around)
            groups, members = self.logits(parts, hidden, runs)
            for chances, wanted in ((groups, token // self.members), (members, token % self.members)):
                np.exp(chances, out=chances)
                chances *= (1 / n) / chances.sum(axis=0)
                chances.reshape(-1)[wanted * n + rows] -= 1 / n
            np.matmul(hidden, groups.T, out=slopes[2])
            slopes[3][:] = 0
            back = np.empty((width, n), weights.dtype)
            for group, a, b in runs:
                chances = members[:, a:b]
                np.matmul(hidden[:, a:b], chances.T, out=low_slopes[group])
                np.matmul(lows[group], chances, out=back[:, a:b])
            back += top[:-1] @ groups
            hidden = hidden[:-1]
            back *= 1 - hidden * hidden
            slopes[1][:] = back.sum(axis=1)
            if cells.shape[2] != n:
                cells = np.empty((kinds, width, n), np.int64)
            np.add((around.T.astype(np.int64) * width)[:, None], value, out=cells)
            back = back.astype(np.float64).reshape(-1)
            for k in range(kinds):
                slopes[0][k].reshape(-1)[:] = np.bincount(cells[k].reshape(-1), back, size * width)
            # Adam with rates 0.9 and 0.99; the factors 0.1 and 0.01 of new values are taken into the last lines.
            first *= 0.9
            first += gradient
            second *= 0.99
            gradient *= gradient
            second += gradient
            spread = 0.1 / math.sqrt(1 - 0.99 ** steps)
            np.sqrt(second, out=scale)
            scale += 1e-6 / spread
            np.divide(first, scale, out=scale)
            scale *= 0.1 * rate / (1 - 0.9 ** steps) / spread
            weights -= scale
            seen += n
        return seen


def _stream(vocabulary: Vocabulary, texts: list[str | None] | pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' numbers in a row with the window's reach of padding between them, and the number of tokens of each.

    A list array holds the texts' numbers already.
    """
    rows = texts if isinstance(texts, pa.ListArray) else vocabulary.lists(texts)
    ends = rows.offsets.to_numpy().astype(np.int64)
    lengths, values = np.diff(ends), rows.flatten().to_numpy()
    stream = np.full(len(values) + REACH * (len(lengths) + 1), PAD, np.int32)
    stream[np.arange(len(values)) + np.repeat(REACH * np.arange(1, len(lengths) + 1), lengths)] = values
    return stream, lengths


def examples(vocabulary: Vocabulary, batches: Iterable[list[str | None] | pa.ListArray], every: int, turn: int,
             step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Steps of (around, token) for every ``every``-th place, counted on from batch to batch and beginning with ``turn``."""
    passed = turn
    for texts in batches:
        stream, _ = _stream(vocabulary, texts)
        at = np.flatnonzero(stream != PAD)
        passed, at = passed + len(at), at[(np.arange(len(at)) + passed) % every == 0]
        for start in range(0, len(at), step):
            here = at[start:start + step]
            yield _around(stream, here), stream[here]


def _around(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([stream[at + k] for k in range(-REACH, REACH + 1) if k], axis=1)


class Lexicon:
    """Words by number, and what gives the share of a word in its number.

    ``frequency`` has the counts of the numbers, ``totals`` those of the shared ones, ``middle`` the log-shares of the more frequent
    of their words, and ``counts`` is the table ``word, n`` of all others that come up more than once; it stays out of the tasks.
    """

    def __init__(self, vocabulary: Vocabulary, frequency: np.ndarray, totals: np.ndarray, middle: dict[bytes, float], counts: DataFrame):
        self.vocabulary, self.frequency, self.totals, self.middle, self.counts = vocabulary, frequency, totals, middle, counts

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counts": None}

    def columns(self, texts: list[str | None]) -> dict:
        """Numbers of every text's words and their summed log-shares, where words neither frequent nor in ``middle`` count as met
        once. The first text of a block has these words of the whole block, each with the places of its texts after the first."""
        own, middle, first = self.vocabulary.own, self.middle, self.vocabulary.first
        once = -np.log(self.totals + 1)
        found = {"numbers": [], "share": [], "rare": []}
        for words, lengths in word_blocks(texts):
            known, at = distinct(words)
            number = self.vocabulary.every(known)
            share = np.array([0.0 if w in own else middle.get(w, 1.0) for w in known], float)  # no share's logarithm is above 0
            rare = share > 0
            share[rare] = once[number[rare] - first]
            text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            found["numbers"].append(lists(lengths, number[at]))
            found["share"].append(pa.array(np.bincount(text, share[at], len(lengths)), pa.float64()))
            picked = rare[at]
            text, at = text[picked], at[picked]
            which = np.flatnonzero(rare)
            places = lists(np.bincount(at, minlength=len(known))[which], text[np.argsort(at, kind="stable")])
            met = pa.StructArray.from_arrays([pa.array([known[i] for i in which], pa.binary()), places], ["word", "places"])
            found["rare"].append(lists(np.r_[len(which), np.zeros(len(lengths) - 1, np.int64)], met))
        return {name: pa.chunked_array(parts) if parts else [] for name, parts in found.items()}


class Scorer:
    """A trained network with its lexicon."""

    def __init__(self, lexicon: Lexicon, network: Network, weights: np.ndarray):
        self.lexicon, self.network, self.weights = lexicon, network, weights
        self.vocabulary, self.middle, self.counts = lexicon.vocabulary, lexicon.middle, lexicon.counts

    def __getstate__(self) -> dict:
        return {"network": self.network, "weights": self.weights, "vocabulary": None}  # numbers are given to tasks

    def scores(self, texts: list[str | None] | pa.ListArray, piece: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and summed log-probability of the numbers of every text."""
        stream, lengths = _stream(self.vocabulary, texts)
        at, parts = np.flatnonzero(stream != PAD), self.network.split(self.weights)
        found = np.zeros(len(at) + 1)
        for start in range(0, len(at), piece):
            here = at[start:start + piece]
            found[start:start + len(here)] = self.network.logs(parts, _around(stream, here), stream[here])
        sums = np.concatenate([[0.0], np.cumsum(found[:-1])])
        ends = np.cumsum(lengths)
        return lengths, sums[ends] - sums[ends - lengths]


def lexicon(docs: DataFrame, own: int | None, shared: int, frequent: float, met: int, known: float) -> Lexicon:
    counts = written(word_counts(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent_words = counts if own is not None else counts.filter(F.col("n") >= max(met, frequent * total))
    frequent_words = frequent_words.orderBy(F.desc("n"), "word")
    top = (frequent_words if own is None else frequent_words.limit(own)).collect()
    vocabulary = Vocabulary([bytes(row.word) for row in top], shared)
    frequency = np.ones(vocabulary.size)
    for row in top:
        frequency[vocabulary.own[bytes(row.word)]] += row.n
    rest = counts.join(counts.sparkSession.createDataFrame([(bytes(r.word),) for r in top], "word binary"), "word", "left_anti")
    slot, totals = F.pmod(F.crc32("word"), F.lit(shared)), np.zeros(shared)
    for row in rest.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).collect():
        totals[row.slot] = row.n
    frequency[vocabulary.first:] += totals
    middle = {bytes(r.word): math.log(r.n / (totals[r.slot] + 1))
              for r in rest.filter(F.col("n") >= known * total).select("word", "n", slot.alias("slot")).collect()}
    tail = rest.filter((F.col("n") > 1) & (F.col("n") < known * total))
    return Lexicon(vocabulary, frequency, totals, middle, tail)


def numbered(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``row, doc_id, numbers, share, rare`` per row of ``docs``, written once for all rounds and for the scores.

    Rows of a task are counted on, so places of ``rare`` count from ``row``.
    """
    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch["doc_id"], **lexicon.columns(batch["text"].to_pylist())}

    rows = map_arrow(only(docs, doc_id="doc_id", text="text"), work,
                     "doc_id long, numbers array<int>, share double, rare array<struct<word: binary, places: array<int>>>")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "numbers")


def fit(docs: DataFrame, **parameters) -> Scorer:
    """The scorer of ``fit_and_score``."""
    return _fit(docs, **parameters)[0]


def fit_and_score(docs: DataFrame, **parameters) -> DataFrame:
    """Scores of all rows of ``docs`` by a network that is trained on them; texts are taken apart once for both."""
    scorer, rows = _fit(docs, **parameters)
    return _scored(rows, scorer)


def _fit(docs: DataFrame, own: int | None = None, shared: int = 128, hidden: int = 24, every: int = 1, rounds: int = 2,
         rate: float = 0.01, step: int = 512, seed: int = 5, frequent: float = 1e-4, met: int = 20,
         known: float = 1e-5) -> tuple[Scorer, DataFrame]:
    """Count words and train over all rows of ``docs``; also their numbers.

    The words of all texts are counted. Those that make up ``frequent`` of all tokens, and come up ``met`` times, have numbers
    of their own; ``own`` takes that many of the most frequent ones instead. In a round every token of every text is an example; an ``every`` above 1 takes only
    every ``every``-th place of the texts of a task, counted on from text to text, with another first place in every round. The driver gets
    the words above ``frequent`` and ``known`` of all tokens (at most 1 / ``known``) and the weights; the shares of all other
    words stay in the table of counts. Sums of weights are made by Spark.
    """
    lexed = lexicon(docs, own, shared, frequent, met, known)
    rows = numbered(docs, lexed)
    network = Network(lexed.vocabulary.size, hidden)
    weights = network.start(lexed.frequency / lexed.frequency.sum(), seed)
    source = only(rows, numbers="numbers")
    for turn in range(rounds):
        weights = _round(source, lexed.vocabulary, network, weights, every, turn, rate / (turn + 1), step)
    return Scorer(lexed, network, weights), rows


def _round(source: DataFrame, vocabulary: Vocabulary, network: Network, weights: np.ndarray, every: int, turn: int,
           rate: float, step: int) -> np.ndarray:
    schema = pa.schema([("place", pa.int32()), ("value", pa.float64()), ("weight", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = weights.copy()
        texts = (batch["numbers"] for batch in batches)
        seen = network.train(mine, examples(vocabulary, texts, every, turn, step), rate)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(mine)), pa.int32()), pa.array(mine * float(seen), pa.float64()),
                 pa.array(np.full(len(mine), seen), pa.int64())], schema=schema)

    parts = source.mapInArrow(work, "place int, value double, weight long")
    mean = parts.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value"))
    out = weights.copy()
    for row in mean.collect():
        out[row.place] = row.value
    return out


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood`` per row.

    A null or empty text has no tokens, a sum of 0 and no mean. Rows of one id stay separate rows.
    """
    return _scored(numbered(docs, scorer.lexicon), scorer)


def _scored(rows: DataFrame, scorer: Scorer) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict:
        lengths, sums = scorer.scores(batch["numbers"])
        return {"row": batch["row"], "doc_id": batch["doc_id"], "n_tokens": lengths, "known": sums + batch["share"].to_numpy()}

    found = map_arrow(rows.select("row", "doc_id", "numbers", "share"), work, "row long, doc_id long, n_tokens long, known double")
    # A word that is in no count, or was met once, adds the logarithm of 1.
    more = (rows.select("row", F.inline("rare")).join(scorer.counts, "word")
            .select("row", F.log("n").alias("share"), F.explode("places").alias("place"))
            .groupBy((F.col("row") + F.col("place")).alias("row")).agg(F.sum("share").alias("more")))
    total = F.col("known") + F.coalesce("more", F.lit(0.0))
    return found.join(more, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))
