import math
import zlib
from collections import Counter

import numpy as np
import pytest
from frames import OWN, TEXTS, documents, empty
from tokenizers import Tokenizer

from tessera.llm import mixing, tokenfiles
from tessera.llm.queries import vocabulary_file
from tessera.session import fresh_path


def test_files_hold_all_documents_in_order(spark):
    library = Tokenizer.from_file(vocabulary_file())
    rows = sorted(tokenfiles.round_trip(documents(spark), vocabulary_file()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, *_ in TEXTS), key=lambda d: -1 if d is None else d)
    tokens = Counter()
    for doc_id, text, *_ in TEXTS:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        tokens[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == tokens
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    assert tokenfiles.round_trip(empty(spark), vocabulary_file()).count() == 0


def test_flat_files(spark):
    folder = fresh_path(spark, "tokens")
    parts = tokenfiles.write(documents(spark), vocabulary_file(), folder).orderBy("part").collect()
    assert sum(p.n_docs for p in parts) == len(TEXTS) and parts[0].base_tokens == 0
    for p in parts:
        part = tokenfiles.Part(folder, p.name, p.width)
        ids, offsets = part.array("ids", "<u2"), part.array("off", "<u8")
        assert isinstance(ids, np.memmap) and len(ids) == p.n_tokens == offsets[-1] and len(offsets) == p.n_docs + 1
        assert (ids[offsets[1:].astype(int) - 1] == 0).all()
    for a, b in zip(parts, parts[1:]):
        assert b.base_tokens == a.base_tokens + a.n_tokens and b.base_docs == a.base_docs + a.n_docs


def slow_weights(tokens, entropy, repeats, budget):
    """Weights by a plain search of the exponent, downwards for the entropy, then upwards for the repetitions."""
    share = tokens / tokens.sum()

    def weights(x):
        return share ** x / (share ** x).sum()

    def spread(x):
        w = weights(x)
        return -(w * np.log(w)).sum() / math.log(len(w)) if len(w) > 1 else 1

    def repeated(x):
        ratio = weights(x) / tokens
        return ratio.max() * (budget or 1 / ratio.min())

    def search(low, high, holds):
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low

    x = 1.0
    if entropy is not None and spread(1.0) < entropy:
        x = search(0, 1, lambda x: spread(x) >= entropy)
    if repeats is not None and repeated(x) > repeats:
        x = search(x, 1, lambda x: repeated(x) > repeats)
    return x, weights(x)


@pytest.mark.parametrize("tokens, entropy, repeats, budget", [
    ([1000, 100, 10, 10], 0.9, None, None), ([1000, 100, 10, 10], 0.9, 3.0, None), ([1000, 100, 10, 10], 0.1, 9.0, None),
    ([1000, 100, 10, 10], 1.0, 4.0, 5000.0), ([5], 0.9, 2.0, None), ([7, 7, 7], 0.9, 2.0, None), ([10**12, 1], 0.9, None, None),
    (list(range(1, 400)), None, 2.0, 100_000.0), (list(range(1, 400)), 0.99, None, None)])
def test_exponent_meets_its_target(spark, tokens, entropy, repeats, budget):
    totals = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate([*tokens, 0])], "_key string, _n long")
    shares, counts = mixing.Shares(totals), np.array(tokens, float)
    wanted, weights = slow_weights(counts, entropy, repeats, budget)
    assert shares.exponent(entropy, repeats, budget) == pytest.approx(wanted, abs=1e-9)
    rows = {r["_key"]: r for r in shares.plan(totals, entropy, repeats, budget).collect()}
    whole = budget or (counts / weights).max()
    for i, n in enumerate(tokens):
        row = rows[f"s{i}"]
        assert row["_weight"] == pytest.approx(weights[i], rel=1e-6)
        assert row["_passes"] * n + row["_rest"] == pytest.approx(weights[i] * whole, rel=1e-6, abs=1 + 2e-6 * n)
    assert tuple(rows[f"s{len(tokens)}"])[1:] == (0.0, 1, 0)


def many(spark, n=3000):
    return spark.range(n).selectExpr(
        "id as doc_id", "repeat(concat('w', id % 17, ' '), cast(1 + id % 23 as int)) as text",
        "case when id % 2 = 0 then 'hot' when id % 31 = 0 then null else concat('s', id % 7) end as source")


@pytest.mark.parametrize("options", [{}, {"budget": 15_000.0, "entropy": 0.95, "repeats": None}, {"entropy": None, "repeats": None},
                                     {"block_rows": 100}])
def test_budgets_are_met_by_whole_passes_and_a_cut_one(spark, options):
    docs = many(spark)
    rows = mixing.mix(docs, **options).collect()
    length = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    assert all(r.source == source[r.doc_id] for r in rows)
    totals = Counter()
    for d, s in source.items():
        totals["-" if s is None else "+" + s] += length[d]
    settings = {"entropy": 0.9, "repeats": 4.0, "budget": None, **options}
    settings.pop("block_rows", None)
    keys, counts = sorted(totals), np.array([totals[k] for k in sorted(totals)], float)
    weights = slow_weights(counts, **settings)[1]
    shares = weights * (settings["budget"] or (counts / weights).max())
    plan = {k: divmod(math.floor(s + 1e-6 * n), int(n)) for k, s, n in zip(keys, shares, counts)}
    used, times = Counter(), Counter()
    for r in rows:
        used["-" if r.source is None else "+" + r.source] += length[r.doc_id]
        times[r.doc_id] += 1
        assert 0 <= r.epoch < 5
    for key, (passes, rest) in plan.items():
        whole = passes * totals[key]
        assert whole + rest - 23 < used[key] <= whole + rest or (rest == 0 and used[key] == whole)
    for d, s in source.items():
        assert plan["-" if s is None else "+" + s][0] <= times[d] <= plan["-" if s is None else "+" + s][0] + 1
    if not options:
        assert min(times[d] for d in source) == 1  # the default budget loses no document
    assert Counter((r.doc_id, r.epoch) for r in rows).most_common(1)[0][1] == 1


def test_mixing_awkward_rows(spark):
    docs = documents(spark)
    out = mixing.mixed(docs, repeats=2.0)
    assert out.columns == docs.columns
    assert all(r[c] == v for r in out.collect() for c, v in OWN.items())
    times = Counter((r.doc_id, r.text) for r in out.collect())
    assert all(times[d, t] >= 1 for d, t, *_ in TEXTS)
    assert mixing.mixed(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    assert mixing.mix(docs).columns == ["doc_id", "source", "epoch", "block", "block_order"]
