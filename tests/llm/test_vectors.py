import math

import numpy as np
import pytest

from tessera.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n_links string, links int, table int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], SCHEMA)


def slow(rows, least):
    def good(e, label):
        return label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)

    units = [np.array(e, np.float32).astype(float) if good(e, label) else None for _, e, label in rows]
    units = [None if u is None else u / np.sqrt(u @ u) for u in units]
    n, parent, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) \
                    and units[i] @ units[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least_id = {}
    for i, (vec_id, *_) in enumerate(rows):
        known = [x for x in (least_id.get(find(i)), vec_id) if x is not None]
        least_id[find(i)] = min(known) if known else None
    return sorted(((r[0], links[i], least_id[find(i)], r[0] == least_id[find(i)]) for i, r in enumerate(rows)), key=str)


def clusters(seed, count=12, copies=15, size=16, noise=0.03):
    rng, rows = np.random.default_rng(seed), []
    for c in range(count):
        centre = rng.standard_normal(size)
        for _ in range(copies):
            rows.append((len(rows), (centre + noise * rng.standard_normal(size)).astype(np.float32).tolist(), c % 3))
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_links_and_components(spark, block):
    """A small block cuts every bucket into pairs of blocks."""
    rows = clusters(1) + [(1000 + i, r[1], r[2]) for i, r in enumerate(clusters(1)[:20])]
    got = sorted(map(tuple, vectors.near_duplicates(frame(spark, rows), 0.99, block=block).collect()), key=str)
    assert got == slow(rows, 0.99)


def test_awkward_rows(spark):
    one, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(0, one, 1), (1, one, 1), (1, one, 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0, 0.0], 1), (5, [nan, 1.0, 1.0], 1),
            (6, [inf, 1.0, 1.0], 1), (7, [None, 1.0, 1.0], 1), (8, one, None), (None, one, 1), (None, None, None), (9, one, 2),
            (10, [1.0, 2.0], 1), (11, [2.0, 4.0, 6.0], 1), (12, [-1.0, -2.0, -3.0], 1), (13, [1e-30, 2e-30, 3e-30], 1),
            (14, [0.0, -0.0, 1.0], 3), (15, [-0.0, 0.0, 1.0], 3), (16, one, None), (None, one, 5)]
    got = vectors.near_duplicates(frame(spark, rows), 0.98)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == slow(rows, 0.98)
    assert vectors.near_duplicates(frame(spark, []), 0.98).count() == 0


def test_threshold_is_exact_and_recall_high(spark):
    """Pairs just above and just below the threshold, in many directions."""
    rng, rows = np.random.default_rng(4), []
    for i in range(400):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        cosine = 0.9801 if i % 2 else 0.9799
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (cosine * a + math.sqrt(1 - cosine**2) * b).tolist(), 0)]
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(frame(spark, rows), 0.98).collect()}
    assert [got[2 * i] for i in range(400)] == [i % 2 for i in range(400)]
