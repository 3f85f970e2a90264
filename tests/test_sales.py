import datetime
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import baskets, itemsets, series
from tessera.plans.sales import refresh_sales


def brute_rules(data, min_count, min_confidence):
    docs = {}
    for d, i in data:
        docs.setdefault(d, set())
        if i is not None:
            docs[d].add(i)
    single, pair = Counter(), Counter()
    for items in docs.values():
        single.update(items)
        pair.update(itertools.permutations(sorted(items), 2))
    n = len(docs)
    return {
        (a, b): (c / single[a], c / single[a] / (single[b] / n), c / n)
        for (a, b), c in pair.items() if c >= min_count and c / single[a] >= min_confidence}


def basket_rows():
    rng = random.Random(5)
    data = [(d, f"i{rng.randrange(12)}") for d in range(150) for _ in range(rng.randrange(1, 6))]
    data += [(d, f"i{k}") for d in (900, 901, 902) for k in range(12)]  # very wide baskets
    data += [(903, f"i{k}") for k in range(12) for _ in range(200)]  # one basket with most of the rows
    return data + [(999, None), (999, None)]


@pytest.mark.parametrize("wide", [3, 6, 1000])
@pytest.mark.parametrize("min_count", [1, 2, 3, 12])
def test_pair_rules_match_brute_force_whatever_counts_as_wide(spark, wide, min_count):
    data = basket_rows()
    df = spark.createDataFrame(data, "d long, i string")
    got = {(r[0], r[1]): tuple(r)[2:] for r in baskets.pair_rules(df, "d", "i", min_count, 0.05, wide).collect()}
    wanted = brute_rules(data, min_count, 0.05)
    assert got.keys() == wanted.keys()
    for key, values in wanted.items():
        assert np.allclose(got[key], values)


def brute_itemsets(rows, min_count):
    held = defaultdict(set)
    for d, i in rows:
        held[i].add(d)
    level = {(i,): d for i, d in held.items() if len(d) >= min_count}
    out = {}
    while level:
        out.update({k: len(d) for k, d in level.items()})
        level = {(*k, i): d & held[i] for k, d in level.items() for i in held if i > k[-1] and len(d & held[i]) >= min_count}
    return out


@pytest.mark.parametrize("matrix", [0, 12, itemsets.MATRIX])
@pytest.mark.parametrize("min_count", [3, 12])
def test_itemsets_wherever_they_are_mined(spark, matrix, min_count):
    rows = sorted({r for r in basket_rows() if r[1] is not None})
    found = itemsets.mine(spark.createDataFrame(rows, "document long, item string"), min_count, matrix).collect()
    assert len(found) == len({tuple(r["items"]) for r in found})
    assert {tuple(r["items"]): r["n"] for r in found} == brute_itemsets(rows, min_count)


def test_itemsets_with_a_basket_of_thousands_of_items(spark):
    rows = [(0, i) for i in range(5000)] + [(d, i) for d in range(1, 60) for i in range(d % 7, 5000, 700)]
    df = spark.createDataFrame(rows, "d long, i int").union(spark.createDataFrame([(3, None), (None, 5)], "d long, i int"))
    found = {tuple(r["items"]): r["n"] for r in baskets.frequent_itemsets(df, "d", "i", 7).collect()}
    assert found == brute_itemsets([*rows, (-1, 5)], 7)
    assert baskets.frequent_itemsets(df.limit(0), "d", "i", 2).count() == 0


def test_itemsets_of_classes_with_more_rows_than_a_task_takes(spark):
    rows = sorted({r for r in basket_rows() if r[1] is not None})
    rows += [(1000 + 7 * k + t, i) for k, items in enumerate([("a", "b"), ("a", "b", "zz"), ("zz", "yy")]) for t in range(3 + k) for i in items]
    found = itemsets.mine(spark.createDataFrame(rows, "document long, item string"), 3, most=20).collect()
    assert len(found) == len({tuple(r["items"]) for r in found})
    assert {tuple(r["items"]): r["n"] for r in found} == brute_itemsets(rows, 3)


def test_equal_baskets_are_one_with_a_weight(spark):
    rows = [(d, i) for d in range(300) for i in ((1, 2, 3) if d < 37 else (1, 3) if d < 100 else (2,))]
    alike = itemsets._alike(spark.createDataFrame(rows, "document long, item int")).collect()
    weights = {}
    for r in alike:
        weights.setdefault((r["basket"], r["weight"]), []).append(r["item"])
    assert sorted((sorted(items), w) for (_, w), items in weights.items()) == sorted(
        [([1, 2, 3], w) for w in (1, 4, 32)] + [([1, 3], w) for w in (1, 2, 4, 8, 16, 32)])
    places, words = itemsets._places(np.array([4] * 70 + [1, 4]))
    assert len(set(places)) == 72 and words.tolist() == [1, 4, 4]
    assert all(words[p // 64] == w for p, w in zip(places, [4] * 70 + [1, 4]))


def test_pair_rules_equal_the_miner(spark):
    df = spark.createDataFrame(basket_rows(), "d long, i string")
    mined = {(r[0], r[1]): tuple(r)[2:] for r in baskets.mined_pair_rules(df, "d", "i", 10, 0.05).collect()}
    paired = {(r[0], r[1]): tuple(r)[2:] for r in baskets.pair_rules(df, "d", "i", 10, 0.05).collect()}
    assert mined.keys() == paired.keys()
    assert all(np.allclose(mined[k], paired[k]) for k in mined)


def test_relative_support_survives_rounding():
    for n in range(11, 3000):
        assert math.ceil(baskets.relative_support(10, n) * n) == 10
    with pytest.raises(ValueError):
        baskets.relative_support(10, 0)


def test_baskets_are_one_row_per_document(spark):
    df = spark.createDataFrame(basket_rows(), "d long, i string")
    assert baskets.basket_count(df, "d").first()[0] == 155
    rows = baskets.baskets(df, "d", "i").collect()
    whole = {r["document"]: r["items"] for r in rows}
    assert len(rows) == len(whole) == 155 and whole[999] == [] and len(whole[903]) == 12


def test_the_null_document_is_a_basket(spark):
    df = spark.createDataFrame([(d, i) for d in (1, 2, None) for i in "ab"], "d long, i string")
    for least in (2, 3):
        for rules in (baskets.pair_rules(df, "d", "i", least, 0.1), baskets.mined_pair_rules(df, "d", "i", least, 0.1)):
            found = {(r["antecedent"], r["consequent"]): (r["confidence"], r["lift"], r["support"]) for r in rules.collect()}
            assert set(found) == {("a", "b"), ("b", "a")}
            assert np.allclose(list(found.values()), 1.0)


def sales_rows():
    start = datetime.date(2023, 1, 1)
    days = [start + datetime.timedelta(days=i) for i in range(0, 500, 3)]
    return [(d, k, 10.0 + i % 7) for i, d in enumerate(days) for k in ("a", "b") if not (k == "b" and i % 2)]


def test_series_is_regular_and_covers_one_year(spark):
    df = spark.createDataFrame(sales_rows(), "day date, k string, amount double")
    daily = series.regular_daily_series(df, "day", F.col("amount"))
    dates = sorted(r["date"] for r in daily.collect())
    assert dates == [dates[0] + datetime.timedelta(days=i) for i in range(len(dates))]
    last = max(r[0] for r in sales_rows())
    assert dates[-1] == last and dates[0] >= last.replace(year=last.year - 1)
    by_key = series.regular_daily_series(df, "day", F.col("amount"), ["k"])
    assert by_key.groupBy("k").count().select("count").distinct().count() == 1
    kept = [r for r in sales_rows() if r[0] >= last.replace(year=last.year - 1)]
    assert by_key.agg(F.sum("total_amount")).first()[0] == sum(r[2] for r in kept)
    train, test = series.holdout_split(daily, 7)
    assert test.count() == 7 and train.count() + 7 == daily.count()
    assert series.with_future_rows(daily, 7).count() == daily.count() + 7


def test_forecast_follows_a_weekly_pattern_and_trend():
    t = np.arange(200)
    y = 100 + 0.5 * t + 20 * (t % 7 == 5)
    out, method = series.seasonal_arima_forecast(y, 7)
    assert method == "seasonal arima"
    future = np.arange(200, 207)
    assert np.allclose(out, 100 + 0.5 * future + 20 * (future % 7 == 5), atol=1.0)


def test_very_short_series_repeat_the_last_week_and_say_so():
    out, method = series.seasonal_arima_forecast(np.arange(10.0), 9)
    assert (out.tolist(), method) == ([3, 4, 5, 6, 7, 8, 9, 3, 4], "seasonal naive")
    assert series.seasonal_arima_forecast(np.array([4.0]), 2)[0].tolist() == [4, 4]


@pytest.mark.parametrize("days", [11, 20, 34, 35, 60])
def test_a_straight_line_goes_on_at_any_length(days):
    out, method = series.seasonal_arima_forecast(np.arange(1.0, days + 1), 3)
    assert np.allclose(out, [days + 1, days + 2, days + 3]) and method == "seasonal arima"


def test_plain_and_seasonal_terms_are_multiplied():
    """A known process: (1 - 0.6 B)(1 - 0.5 B^7) w = e has a lag 8 with the product of both coefficients."""
    rng = np.random.default_rng(0)
    w = np.zeros(3000)
    noise = rng.standard_normal(3000)
    for t in range(8, 3000):
        w[t] = 0.6 * w[t - 1] + 0.5 * w[t - 7] - 0.3 * w[t - 8] + noise[t]
    _, on_w, on_shocks, _ = series._least_squares(w, noise, (1, 0, 1, 0), 7)
    assert np.allclose([on_w[0], on_w[6], on_w[7]], [0.6, 0.5, -0.3], atol=0.05) and not on_shocks.any()
    moving = noise.copy()
    moving[8:] += 0.4 * noise[7:-1] + 0.3 * noise[1:-7] + 0.12 * noise[:-8]
    _, _, on_shocks, _ = series._least_squares(moving, noise, (0, 1, 0, 1), 7)
    assert np.allclose([on_shocks[0], on_shocks[6], on_shocks[7]], [0.4, 0.3, 0.12], atol=0.03)


def test_refresh_job(spark):
    rows = [(i % 40, f"p{i % 5}", f"2024-0{1 + i % 6}-1{i % 9} 00:00:00", float(i % 13)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc long, item string, at string, amount double")
    stamp = datetime.datetime(2025, 1, 1)
    rules, ahead = refresh_sales(df.withColumn("at", F.try_to_date("at", "yyyy-MM-dd HH:mm:ss")), "doc", "item", "at", "amount",
                                 min_count=2, at=stamp)
    assert rules.filter("insert_timestamp is null").isEmpty()
    dates = sorted(r["date"] for r in ahead.collect())
    assert dates == [datetime.date(2024, 6, 19) + datetime.timedelta(days=i) for i in range(7)]


def test_the_miner_is_read_once(spark, monkeypatch):
    rows = [(i % 40, f"b{(i * i + i // 7) % 9}") for i in range(300)] + [(None, "b1"), (None, "b2"), (3, None)]
    df = spark.createDataFrame(rows, "doc long, item string")
    reads = []
    fitted = baskets._fitted

    class Once:
        def __init__(self, model):
            self.model = model

        @property
        def freqItemsets(self):
            reads.append(1)
            return self.model.freqItemsets

    def counted(*args):
        model, found = fitted(*args)
        return Once(model), found

    monkeypatch.setattr(baskets, "_fitted", counted)
    mined = baskets.mined_pair_rules(df, "doc", "item", 3, 0.1)
    close = lambda df: sorted((r[0], r[1], *(round(x, 9) for x in r[2:])) for r in df.collect())
    assert close(mined) == close(baskets.pair_rules(df, "doc", "item", 3, 0.1)) != [] and len(reads) == 1
