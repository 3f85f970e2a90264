import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from frames import TEXTS, documents, empty

from tessera.llm import periodic


def brute(words, least=6, times=4):
    """Every period and every stretch that keeps it, without suffixes."""
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        start = 0
        while start < n:
            stop = start + q
            while stop < n and words[stop] == words[stop - q]:
                stop += 1
            length = stop - start
            left = start == 0 or start + q > n or words[start - 1] != words[start - 1 + q]
            if stop <= n and length >= max(least, times * q) and left:
                part = words[start:stop]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((start, length, q))
            start = max(start + 1, stop - q)
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        words, size = [], rng.randint(1, 5)
        while len(words) < rng.randint(0, 90):
            part = [rng.choice("abcdefgh"[:size]) for _ in range(rng.randint(1, 6))]
            words += part * rng.choice([1, 1, 2, 4, 6, 9]) + part[:rng.randint(0, len(part))]
        out.append([w.encode() for w in words])
    return out


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (10, 3), (1, 5)])
def test_runs_of_random_words(least, times):
    for seed in range(15):
        batch = texts(seed)
        assert periodic.runs_of_texts(batch, least, times) == [brute(words, least, times) for words in batch]


def test_smallest_prefix_loses_no_run():
    for least in range(1, 14):
        for times in range(2, 7):
            wanted = min(max(least, times * q) - q for q in range(1, 60))
            assert periodic.smallest_prefix(least, times) == max(1, wanted)


def test_suffix_neighbours():
    rng = np.random.default_rng(5)
    for size, letters in [(1, 1), (2, 1), (50, 1), (300, 2), (400, 20), (0, 1)]:
        words = rng.integers(0, letters, size)
        suffixes = sorted(range(size), key=lambda i: words[i:].tolist())
        wanted = []
        for a, b in zip(suffixes, suffixes[1:]):
            lcp = 0
            while max(a, b) + lcp < size and words[a + lcp] == words[b + lcp]:
                lcp += 1
            wanted += [(a, b, lcp)] if lcp >= 3 else []
        assert list(zip(*(x.tolist() for x in periodic.sorted_suffixes(words, 3)))) == wanted


def test_very_long_runs_and_many_short_ones():
    same = [b"x"] * 30_000
    turns = [b"a", b"b", b"c"] * 9000
    distinct = [str(i).encode() for i in range(20_000)]
    blocks = [w for i in range(3000) for w in [str(i).encode()] * 7]
    found = periodic.runs_of_texts([same, turns, distinct, blocks, []])
    assert found == [[(0, 30_000, 1)], [(0, 27_000, 3)], [], [(7 * i, 7, 1) for i in range(3000)], []]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_awkward_rows(spark):
    picked = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    more = [(i, " ".join(f"w{j % (3 + i % 7)} é{j}" if j % 5 else "漢字" for j in range(20 + 7 * i % 90)), "en", "a") for i in picked]
    rows = [r for r in TEXTS if len(r[1] or "") < 4000] + more + more[:2] + [(-7, "na " * 40, "en", "a"), (50, "x\x85y " * 9, "en", "a")]
    found = periodic.digests(documents(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted((expected(d, t) for d, t, *_ in rows), key=str)
    assert sum(r.n_runs > 0 for r in found) > 10
    assert periodic.digests(empty(spark)).count() == 0


def test_texts_of_one_block_do_not_meet(monkeypatch):
    words = [(t or "").encode().split() for _, t, *_ in TEXTS]
    assert periodic.runs_of_texts(words) == [periodic.runs_of_texts([w])[0] for w in words]
    monkeypatch.setattr(periodic, "BLOCK", 3)
    assert list(periodic._blocks([b"ab", None, b"c", b"de", b"long one", b"", None])) == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(periodic._blocks([])) == []
