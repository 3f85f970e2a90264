import random

import numpy as np
import pytest
import xxhash
from frames import OWN, TEXTS, documents, empty

from tessera.llm import simhash
from tessera.llm.components import components


def slow_fingerprint(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    pieces = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(codes, distance):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def signed(code):
    return code - (1 << 64) if code >> 63 else code


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_fingerprint(size):
    for _, text, *_ in TEXTS:
        short = (text or "")[:5000]
        assert simhash.fingerprint(short.encode(), size) % (1 << 64) == slow_fingerprint(short, size)


def test_long_texts_are_summed_in_pieces():
    text = " ".join(str(i * i) for i in range(3000)).encode()
    assert simhash.fingerprint(text, 3, piece=100) == simhash.fingerprint(text, 3)


def test_gray_rank_orders_by_gray_code():
    codes = np.array([i ^ i >> 1 for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(1000)).all()


@pytest.mark.parametrize("distance,limit", [(0, 1024), (1, 8), (3, 1024), (3, 8), (5, 64)])
def test_links_connect_exactly_what_is_near(spark, distance, limit):
    """A small limit deals crowded groups out again and again; chains and crowds are found all the same."""
    random.seed(distance)
    codes = {random.getrandbits(64) for _ in range(60)}
    for code in list(codes)[:20]:
        for _ in range(6):
            for _ in range(distance):
                code ^= 1 << random.randrange(64)
            codes.add(code)
    crowd = random.getrandbits(64)
    codes |= {crowd ^ 1 << a ^ 1 << b for a in range(0, 64, 7) for b in range(0, 64, 5)}
    codes = sorted(codes)
    nodes = spark.createDataFrame([(signed(c),) for c in codes], "node long")
    found = {r.node: r.root for r in components(simhash.links(nodes, distance, limit)).collect()}
    wanted = slow_groups(codes, distance)
    got = [found.get(signed(c), signed(c)) for c in codes]
    assert len(set(zip(got, wanted))) == len(set(got)) == len(set(wanted))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({found[i] for i in range(301)}) == 1 and len({found[i] for i in range(1000, 1200)}) == 1
    assert found[0] != found[1000] and 5000 not in found


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    codes = [slow_fingerprint(t) for _, t, *_ in TEXTS]
    groups = slow_groups(codes, 3)
    least = {}
    for (doc_id, *_), group in zip(TEXTS, groups):
        known = [d for d in (least.get(group), doc_id) if d is not None]
        least[group] = min(known) if known else None
    wanted = sorted(((d, f"{c:016x}", least[g]) for (d, *_), c, g in zip(TEXTS, codes, groups)), key=str)
    assert sorted(map(tuple, rows), key=str) == wanted
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert all(r[c] == v for r in kept.collect() for c, v in OWN.items())
    groups = {}
    for (doc_id, text, *_), group in zip(TEXTS, slow_groups([slow_fingerprint(t) for _, t, *_ in TEXTS], 3)):
        groups.setdefault(group, []).append((doc_id is None, doc_id))
    assert sorted(((r.doc_id is None, r.doc_id) for r in kept.collect()), key=str) == sorted((min(g) for g in groups.values()), key=str)
    assert simhash.without_near_duplicates(empty(spark)).count() == 0
