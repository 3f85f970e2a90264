import math
import statistics
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import distributions as dist
from tessera.operators import describe, hypothesis, regression


def test_normal_quantile(spark):
    points = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.77, 0.99, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    got = [r[0] for r in df.select(F.expr(hypothesis.normal_quantile_sql("p"))).collect()]
    assert np.allclose(got, [statistics.NormalDist().inv_cdf(p) for p in points], rtol=1e-8, atol=1e-8)


def test_shapiro_wilk_published_example(spark):
    # Weights of eleven men: W = 0.79, p = 0.007 in the literature.
    men = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    r = hypothesis.shapiro_wilk(spark.createDataFrame(list(enumerate(men)), "id int, x int"), "x", "id").first()
    assert r["w"] == pytest.approx(0.79, abs=0.005) and r["p_value"] == pytest.approx(0.0067, abs=0.001)
    flat = spark.createDataFrame([(i, 1.0) for i in range(5)], "id int, x double")
    assert hypothesis.shapiro_wilk(flat, "x", "id").first()["w"] is None


def test_t_tests(spark):
    a, b = [5.1, 4.9, 6.2, 5.7, 5.5], [4.1, 5.0, 4.4, 4.8]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, x double")
    one = hypothesis.with_t_p_value(hypothesis.t_one_sample(df.filter("g = 'a'"), "x", 5.0), "mean").first()
    t = (np.mean(a) - 5) / (np.std(a, ddof=1) / math.sqrt(5))
    assert one["t"] == pytest.approx(t) and one["df"] == 4 and one["low"] < np.mean(a) < one["high"]
    assert one["p_value"] == pytest.approx(dist.t_two_sided(spark, t, 4))
    two = hypothesis.t_welch(df, "x", "g").first()
    va, vb = np.var(a, ddof=1) / 5, np.var(b, ddof=1) / 4
    assert two["t"] == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert two["df"] == pytest.approx((va + vb) ** 2 / (va**2 / 4 + vb**2 / 3))
    lonely = hypothesis.t_one_sample(df.limit(1), "x", 5.0).first()
    assert lonely["t"] is None


def test_chi_square_with_empty_cell_and_correction(spark):
    cells = [("a", "x", 10), ("a", "y", 20), ("b", "x", 30)]
    df = spark.createDataFrame([(r, c) for r, c, n in cells for _ in range(n)], "r string, c string")
    o = np.array([[10, 20], [30, 0]], float)
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    assert hypothesis.chi_square(df, "r", "c").first()["statistic"] == pytest.approx(((o - e) ** 2 / e).sum())
    corrected = hypothesis.chi_square(df, "r", "c", correct=True).first()
    assert corrected["statistic"] == pytest.approx(((abs(o - e) - 0.5) ** 2 / e).sum()) and corrected["df"] == 1


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 300
    x1, x2 = rng.normal(50, 5, n), rng.normal(1e4, 3, n)
    g = rng.integers(0, 3, n)
    y = 3 + 2 * x1 - 0.5 * x2 + 4 * (g == 2) + rng.normal(0, 2, n)
    rows = [(i, float(a), float(b), "uvw"[c], float(d)) for i, (a, b, c, d) in enumerate(zip(x1, x2, g, y))]
    rows.append((n, None, 1.0, "u", 2.0))
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, g string, y double")
    return df, x1, x2, g, y


def fitted(sample):
    df, x1, x2, g, y = sample
    terms = {"x1": F.col("x1"), "x2": F.col("x2"), **regression.dummies("g", ["u", "v", "w"])}
    design = np.column_stack([np.ones(len(y)), x1, x2, g == 1, g == 2]).astype(float)
    return regression.moments(df, F.col("y"), terms), design, y


def test_least_squares_and_diagnostics(spark, sample):
    moments, design, y = fitted(sample)
    fit = moments.fit()
    centred = design.copy()
    centred[:, 1:] -= centred[:, 1:].mean(0)
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    e = y - design @ beta
    n, p = design.shape
    s2 = e @ e / (n - p)
    table = {r["term"]: r for r in fit.table(spark).collect()}
    assert np.allclose([table[t]["estimate"] for t in ["(intercept)", "x1", "x2", "g=v", "g=w"]], beta, rtol=1e-6)
    slopes = np.linalg.inv(centred.T @ centred)
    assert table["x1"]["standard_error"] == pytest.approx(math.sqrt(s2 * slopes[1, 1]), rel=1e-6)
    assert fit.r2 == pytest.approx(1 - e @ e / ((y - y.mean()) ** 2).sum())
    assert fit.aic == pytest.approx(n * (math.log(2 * math.pi) + math.log(e @ e / n) + 1) + 2 * (p + 1))
    h = np.einsum("ij,jk,ik->i", centred, slopes, centred)
    rows = sorted(fit.diagnostics(sample[0].filter("x1 is not null")).collect(), key=lambda r: r["id"])
    assert np.allclose([r["leverage"] for r in rows], h)
    assert np.allclose([r["cook"] for r in rows], e**2 * h / (p * s2 * (1 - h) ** 2))
    left_out = (e @ e - e**2 / (1 - h)) / (n - p - 1)
    assert np.allclose([r["studentised"] for r in rows], e / np.sqrt(left_out * (1 - h)))
    d = regression.durbin_watson(sample[0], fit, ["id"]).first()
    assert d["d"] == pytest.approx((np.diff(e) ** 2).sum() / (e @ e)) and 0 < d["p_value"] < 1


def test_a_square_far_from_zero_keeps_its_digits(spark):
    """Exact rational least squares on whole numbers; cross-products in doubles would keep about three digits here."""
    rng = np.random.default_rng(8)
    x = rng.integers(19_000, 21_000, 600).tolist()
    y = [3 * (v - 20_000) ** 2 + 5 * v + int(e) for v, e in zip(x, rng.integers(-900, 900, 600))]
    rows = [[Fraction(1), Fraction(v), Fraction(v) ** 2] for v in x]
    normal = [[sum(r[i] * r[j] for r in rows) for j in range(3)] + [sum(r[i] * t for r, t in zip(rows, y))] for i in range(3)]
    for i in range(3):
        normal[i] = [v / normal[i][i] for v in normal[i]]
        for k in range(3):
            if k != i:
                normal[k] = [a - normal[k][i] * b for a, b in zip(normal[k], normal[i])]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    terms = {"x": F.col("x"), "x^2": F.col("x") * F.col("x")}
    for parts in (1, 12):
        fit = regression.moments(df.repartition(parts), F.col("y"), terms).fit()
        assert [fit.intercept, *fit.coefficients] == pytest.approx([float(r[3]) for r in normal], rel=1e-8)
        residual = sum((t - sum(a * r[3] for a, r in zip(row, normal))) ** 2 for row, t in zip(rows, y))
        assert fit.rss == pytest.approx(float(residual), rel=1e-8)
        total = fit.diagnostics(df).agg(F.sum("leverage"), F.sum(F.col("residual") ** 2)).first()
        assert total[0] == pytest.approx(3, rel=1e-8) and total[1] == pytest.approx(float(residual), rel=1e-8)


def test_fewer_rows_than_terms(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, 5.0)], "a double, b double, y double")
    fit = regression.moments(df, F.col("y"), {"a": F.col("a")}).fit()
    assert fit.coefficients[0] == pytest.approx(2) and fit.rss == pytest.approx(0, abs=1e-20)
    with pytest.raises(ValueError):
        regression.moments(df.limit(0), F.col("y"), {"a": F.col("a")})


@pytest.mark.parametrize("n, terms, low, high", [(15, 1, 1.08, 1.36), (20, 1, 1.20, 1.41), (50, 1, 1.50, 1.59), (40, 3, 1.34, 1.66), (100, 5, 1.57, 1.78)])
def test_bounds_of_the_published_table(n, terms, low, high):
    """At the 5 % bounds of Durbin and Watson the law with the smallest and the largest values gives 5 %."""
    values = np.sort(2 - 2 * np.cos(np.pi * np.arange(1, n) / n))
    for some, bound in ((values[:n - 1 - terms], low), (values[terms:], high)):
        assert dist.ratio_below(some, bound - 0.006) < 0.05 < dist.ratio_below(some, bound + 0.006)


def test_ratio_law_against_simulation_and_closed_form():
    assert dist.ratio_below(np.array([0.0, 2.0]), 1.0) == pytest.approx(0.5, abs=1e-8)
    assert dist.ratio_below(np.array([1.0, 1.0]), 0.5) == 0 and dist.ratio_below(np.array([1.0, 1.0]), 2.0) == 1
    rng = np.random.default_rng(1)
    z = rng.normal(size=(200_000, 6)) ** 2
    values = np.array([0.1, 0.5, 1.0, 2.0, 3.0, 3.9])
    for x in (0.5, 1.5, 2.5):
        assert dist.ratio_below(values, x) == pytest.approx(((z @ values) < x * z.sum(1)).mean(), abs=0.005)


@pytest.mark.parametrize("n", [30, 400])
def test_durbin_watson_law(spark, n):
    rng = np.random.default_rng(n)
    x = np.c_[np.cumsum(rng.normal(size=n)), rng.normal(size=n) + 50]
    e = rng.normal(size=n)
    e[1:] += 0.3 * e[:-1]
    y = 1 + x @ [2.0, -1.0] + e
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "i long, a double, b double, y double")
    fit = regression.moments(df, F.col("y"), {"a": F.col("a"), "b": F.col("b")}).fit()
    found = regression.durbin_watson(df.repartition(5), fit, ["i"]).first()
    design = np.column_stack([np.ones(n), x])
    rest = np.eye(n) - design @ np.linalg.inv(design.T @ design) @ design.T
    near = 2 * np.eye(n) - np.eye(n, k=1) - np.eye(n, k=-1)
    near[0, 0] = near[-1, -1] = 1
    both = rest @ near
    m = n - 3
    mean = np.trace(both) / m
    sd = math.sqrt(2 * (np.trace(both @ both) - np.trace(both) * mean) / (m * (m + 2)))
    r = rest @ y
    assert (found["d"], found["mean"], found["sd"]) == pytest.approx((np.sum(np.diff(r) ** 2) / (r @ r), mean, sd))
    normal = statistics.NormalDist(mean, sd).cdf(found["d"])
    assert found["p_value"] == pytest.approx(normal, abs=1e-9 if n >= 100 else 0.02)
    exact = regression.durbin_watson(df, fit, ["i"], exact_below=1000).first()["p_value"]
    assert exact == pytest.approx(normal, abs=0.01)
    assert regression.durbin_watson(df.limit(0), fit, ["i"]).first()["d"] is None


def test_selection_drops_noise_and_inflation(spark, sample):
    df = sample[0].withColumn("noise", F.rand(3))
    terms = {"x1": F.col("x1"), "x2": F.col("x2"), "noise": F.col("noise"), **regression.dummies("g", ["u", "v", "w"])}
    chosen = set(regression.moments(df, F.col("y"), terms).step().terms)
    assert {"x1", "g=w"} <= chosen and "noise" not in chosen
    inflation = fitted(sample)[0].inflation()
    _, x1, x2, g, _ = sample
    corr = np.linalg.inv(np.corrcoef([x1, x2, g == 1, g == 2]))
    assert np.allclose(list(inflation.values()), np.diag(corr))
    with pytest.raises(ValueError):
        regression.moments(df, F.col("y"), {"one": F.lit(1.0)}).fit()


def test_effect_curve_band(spark, sample):
    df = sample[0]
    fit = regression.moments(df, F.col("y"), {"x1": F.col("x1"), "x1^2": F.col("x1") * F.col("x1"), "x2": F.col("x2")}).fit()
    rows = sorted(regression.effect_curve(df, fit, ["x1", "x2"], "x1", [40, 50, 60]).collect(), key=lambda r: r["x1"])
    assert [r["x1"] for r in rows] == [40, 50, 60]
    assert all(r["low"] < r["predicted"] < r["high"] for r in rows)
    assert rows[1]["standard_error"] < rows[0]["standard_error"]


def test_describe_edges(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 2.0, 5.0), ("b", 4.0, 5.0), ("b", None, 5.0)], "g string, x double, c double")
    out = {r["g"]: r for r in describe.describe(df, ["x"], ["g"]).collect()}
    assert out["a"]["sd"] is None and out["b"]["median"] == 3.0 and out["b"]["n"] == 2
    flat = describe.describe(df, ["c"]).first()
    assert flat["sd"] == 0 and flat["iqr"] == 0
    assert describe.gini_heterogeneity(spark.createDataFrame([("k",)] * 3, "g string"), "g").first()["gini"] is None
    assert describe.gini_heterogeneity(df, "g", 4).first()["gini"] == pytest.approx((1 - (1 + 9) / 16) / 0.75)
    table = sorted(describe.frequency_table(df, "g").collect(), key=lambda r: r["g"])
    assert [(r["n"], r["cumulative_n"]) for r in table] == [(1, 1), (3, 4)] and table[-1]["cumulative_share"] == 1
    weights = {r["label"]: r["weight"] for r in describe.class_weights(
        spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "p int, q int"), ["p", "q"]).collect()}
    assert weights == {"p": 2.0, "q": None}


def test_outliers_and_whiskers(spark):
    df = spark.createDataFrame([("g", float(x)) for x in [1, 2, 3, 4, 5, 100]], "k string, x double")
    r = describe.box_statistics(df, "x", ["k"]).first()
    assert (r["low_whisker"], r["high_whisker"], r["outliers"]) == (1, 5, 1)
    assert [x["x"] for x in describe.outliers(df, "x", ["k"]).collect()] == [100]


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=500)], "x double")
    rows = sorted(describe.density(df, "x").collect(), key=lambda r: r["x"])
    assert np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows]) == pytest.approx(1, abs=0.01)
