"""Runs of words that repeat with a period, found from the suffixes of a text by descending common prefix.

Suffixes are sorted, and neighbours in that order are joined like the edges of a spanning forest, longest common prefix
(LCP) first: union-find classes hold the positions whose suffixes agree in at least the LCP at hand, in ascending order. When two
classes meet, only positions that become neighbours in the joined order can begin a repetition: if ``p`` and ``p + d`` do so at
LCP ``l`` and ``d <= l``, the words from ``p`` on repeat with smallest period ``d`` for ``l + d`` words, and no further
to the right. Were there a smaller period, a position between the two would already be in the class. With the
word before ``p`` unlike the word before ``p + d`` this is a whole run, and every run comes up exactly once.

A run of at least ``least`` words and ``times`` periods needs an LCP of ``max(least - q, (times - 1) q)`` for its period
``q``, so the joining ends below the smallest such value; no run is lost by that. Texts without two equal word
windows of that length need no sorting at all.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.support import map_arrow, only, utf8

LEAST, TIMES = 6, 4  # words and periods of a run
BLOCK = 1 << 20  # bytes of text that are sorted together; a longer text is sorted alone


def smallest_prefix(least: int = LEAST, times: int = TIMES) -> int:
    """The smallest LCP from which a run of ``least`` words and ``times`` periods can come."""
    return max(1, min(max(least - q, (times - 1) * q) for q in range(1, max(2, least + 1))))


def sorted_suffixes(words: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbours in suffix order with an LCP of ``shortest`` or more: left, right, LCP.

    ``words`` are codes from 0 on; different texts in one array have different codes, so that no prefix reaches over
    an end. Ranks by the first 1, 2, 4, ... words are kept, and only classes of equal ranks are sorted on.
    """
    n = len(words)
    levels = [words.astype(np.int32)]
    order = np.argsort(words, kind="stable")
    rank = _ranks(order, words[order])
    levels[0] = rank
    width, active = 1, _shared(rank, order)
    while len(active):
        # ranks are places of the first member, so members of a class can be sorted among themselves
        behind = active + width
        after = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1).astype(np.int64)
        within = np.lexsort((after, rank[active]))
        active, after = active[within], after[within]
        old = rank[active]
        place = np.arange(len(active))
        starts = np.r_[True, old[1:] != old[:-1]]
        new = starts | np.r_[True, after[1:] != after[:-1]]
        base = old - place[starts][np.cumsum(starts) - 1]  # place in the whole order less place among the active
        first = place[new][np.cumsum(new) - 1]
        rank = rank.copy()
        rank[active] = base + first
        order[base + place] = active
        levels.append(rank)
        width *= 2
        size = np.diff(np.r_[place[new], len(active)])
        active = active[np.repeat(size, size) > 1]
    left, right = order[:-1], order[1:]
    length = np.zeros(max(n - 1, 0), np.int64)
    together = np.arange(max(n - 1, 0))
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        a, b = left[together] + length[together], right[together] + length[together]
        inside = (a < n) & (b < n)
        same = inside & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
        length[together[same]] += 1 << level
    kept = length >= shortest
    return left[kept], right[kept], length[kept]


def _ranks(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For every position the place at which its class of equal ``keys`` begins."""
    new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if len(keys) else 0
    return rank


def _shared(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Positions, in order, whose class has another member."""
    size = np.bincount(rank, minlength=len(rank) or 1)
    return order[size[rank[order]] > 1]


def runs(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in an array of codes, by start and period."""
    left, right, lengths = sorted_suffixes(words, smallest_prefix(least, times))
    if not len(left):
        return []
    code = words.tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found = []

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up] if up in parent else up
        return x

    def meet(p: int, q: int, lcp: int) -> None:
        d = q - p
        if d <= lcp and lcp + d >= least and lcp + d >= times * d and (p == 0 or code[p - 1] != code[q - 1]):
            found.append((p, lcp + d, d))

    by_length = np.argsort(-lengths, kind="stable")
    for a, b, lcp in zip(left[by_length].tolist(), right[by_length].tolist(), lengths[by_length].tolist()):
        a, b = root(a), root(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        places = [bisect_left(large, p) for p in small]
        for i, (p, at) in enumerate(zip(small, places)):
            if at and (i == 0 or small[i - 1] < large[at - 1]):
                meet(large[at - 1], p, lcp)
            if at < len(large) and (i == len(small) - 1 or large[at] < small[i + 1]):
                meet(p, large[at], lcp)
        if places[0] == len(large):
            large += small
        elif len(small) < 8:
            for p, at in zip(reversed(small), reversed(places)):
                large.insert(at, p)
        else:
            large += small
            large.sort()
        members[a] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_windows(words: np.ndarray, text_of: np.ndarray, width: int) -> np.ndarray:
    """The texts (numbers in ``text_of``) that hold two equal windows of ``width`` words, and perhaps a few more.

    Windows are told apart by 64-bit hashes: equal windows have equal hashes, and a chance meeting only costs time.
    """
    n = len(words) - width + 1
    if n < 2:
        return np.zeros(0, np.int64)
    hashed = text_of[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(width):
        hashed = (hashed ^ words[i:i + n].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        hashed ^= hashed >> np.uint64(32)
    whole = text_of[:n] == text_of[width - 1:]
    hashed, owner = hashed[whole], text_of[:n][whole]
    ordered = np.sort(hashed)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, hashed), len(twice) - 1)
    return np.unique(owner[twice[at] == hashed])


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
    codes = flat.indices.to_numpy().astype(np.int64)
    text_of, starts = np.repeat(np.arange(len(texts)), lengths), np.r_[0, np.cumsum(lengths)]
    chosen = repeated_windows(codes, text_of, smallest_prefix(least, times))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(chosen):
        return out
    taken = np.isin(text_of, chosen)
    # codes of their own for every text
    _, own = np.unique(text_of[taken] * (len(flat.dictionary) + 1) + codes[taken], return_inverse=True)
    firsts = np.r_[0, np.cumsum(lengths[chosen])]
    for start, length, period in runs(own, least, times):
        i = int(np.searchsorted(firsts, start, "right")) - 1
        out[int(chosen[i])].append((start - int(firsts[i]), length, period))
    return out


def rewritten(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a periodic end in about a tenth of all documents, chosen by the hash of the id; none without an id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside runs, and of every run its first period; a word goes if any run has it after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _blocks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``BLOCK`` bytes, or one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text or b"") > BLOCK:
            yield start, i
            start, size = i, 0
        size += len(text or b"")
    if start < len(texts):
        yield start, len(texts)


def detect(docs: DataFrame, least: int = LEAST, times: int = TIMES, planted: bool = False, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """``doc_id, runs, text``: all runs (start, length, period; numbers of words) and the text with each reduced to its first period.

    The words of the remaining text are joined by one blank. ``planted`` first gives some documents a periodic end (see
    ``rewritten``). A null or empty text has no words and no runs; rows of one id stay separate rows. Rows are
    worked on where they are read, one block of texts at a time; the sorting of one text takes some 100 bytes a word.
    """
    def work(batch: pa.RecordBatch) -> dict:
        ids, texts = batch["doc_id"].to_pylist(), utf8(batch["text"])
        every, rest = [], []
        for start, stop in _blocks(texts):
            words = [(t or b"").split() for t in texts[start:stop]]
            if planted:
                words = [rewritten(w, i) for w, i in zip(words, ids[start:stop])]
            found = runs_of_texts(words, least, times)
            every += found
            rest += [b" ".join(collapsed(w, f)) for w, f in zip(words, found)]
        return {"doc_id": batch["doc_id"], "runs": every, "text": pa.array(rest, pa.binary()).cast(pa.string())}

    return map_arrow(only(docs, doc_id=id_column, text=text_column), work,
                     "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_runs``, the longest run with its exponent in thousandths, and digests of all runs and of the collapsed text.

    Ties between longest runs go to the smallest start, then period; without a run its four columns are null.
    """
    def line(r):
        return f"{r['start']},{r['length']},{r['period']}\n"

    def work(batch: pa.RecordBatch) -> dict:
        runs_of = batch["runs"].to_pylist()
        best = [min(r, key=lambda x: (-x["length"], x["start"], x["period"]), default=None) for r in runs_of]
        sha = lambda data: hashlib.sha256(data).hexdigest()
        return {
            "doc_id": batch["doc_id"], "n_runs": [len(r) for r in runs_of],
            **{name: [b and b[name] for b in best] for name in ("start", "length", "period")},
            "exponent_milli": [b and 1000 * b["length"] // b["period"] for b in best],
            "runs_sha256": [sha("".join(map(line, r)).encode()) for r in runs_of],
            "collapsed_sha256": [sha(t) for t in utf8(batch["text"])],
        }

    return map_arrow(detect(docs, planted=True, id_column=id_column, text_column=text_column), work,
                     "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                     "runs_sha256 string, collapsed_sha256 string")
