"""Hypothesis tests. Statistics are aggregated by Spark; p-values are added to the one result row."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row, functions as F

from tessera.functions import distributions as dist
from tessera.functions.scalar import safe_ratio
from tessera.operators.ordered import running


def chi_square(df: DataFrame, row: str, column: str, correct: bool = False) -> DataFrame:
    """Independence statistic and degrees of freedom, one row.

    Empty cells need not be listed: the statistic equals ``N (sum o^2/(r c) - 1)``.
    ``correct`` applies the continuity correction, which only exists for 2 x 2 tables.
    """
    named = df.select(F.col(row).alias("_row"), F.col(column).alias("_column")).na.drop()
    counts = named.groupBy("_row", "_column").agg(F.count(F.lit(1)).cast("double").alias("o"))
    rows = counts.groupBy("_row").agg(F.sum("o").alias("r"))
    columns = counts.groupBy("_column").agg(F.sum("o").alias("c"))
    cells = counts.join(rows, "_row").join(columns, "_column")
    total = F.sum("o")
    plain = total * (F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))) - 1)
    out = cells.agg(
        plain.alias("plain"), total.alias("n"), F.count_distinct("_row").alias("_r"),
        F.count_distinct("_column").alias("_c"), F.first(F.struct("o", "r", "c")).alias("cell"))
    statistic = F.col("plain")
    if correct:
        o, r, c, n = F.col("cell.o"), F.col("cell.r"), F.col("cell.c"), F.col("n")
        gap = F.greatest(F.abs(o * n - r * c) - n / 2, F.lit(0.0))
        corrected = safe_ratio(n * gap * gap, r * (n - r) * c * (n - c))
        statistic = F.when((F.col("_r") == 2) & (F.col("_c") == 2), corrected).otherwise(statistic)
    return out.select(statistic.alias("statistic"), ((F.col("_r") - 1) * (F.col("_c") - 1)).alias("df"))


def t_one_sample(df: DataFrame, column: str, mu: float) -> DataFrame:
    x = F.col(column).cast("double")
    moments = df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"))
    return moments.select(
        "n", "mean", safe_ratio(F.col("mean") - mu, F.col("sd") / F.sqrt("n")).alias("t"),
        (F.col("n") - 1).cast("double").alias("df"), (F.col("sd") / F.sqrt("n")).alias("standard_error"))


def t_welch(df: DataFrame, column: str, group: str) -> DataFrame:
    """Two groups with unequal variances; the first group is the alphabetically lower one."""
    x = F.col(column).cast("double")
    groups = df.filter(x.isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("v"))
    both = groups.agg(
        F.min_by(F.struct("n", "mean", "v"), group).alias("a"), F.max_by(F.struct("n", "mean", "v"), group).alias("b"),
        F.count(F.lit(1)).alias("groups"))
    sa, sb = F.col("a.v") / F.col("a.n"), F.col("b.v") / F.col("b.n")
    freedom = safe_ratio(
        (sa + sb) * (sa + sb), sa * sa / (F.col("a.n") - 1) + sb * sb / (F.col("b.n") - 1))
    difference = F.col("a.mean") - F.col("b.mean")
    return both.filter("groups = 2").select(
        F.col("a.mean").alias("mean_a"), F.col("b.mean").alias("mean_b"),
        safe_ratio(difference, F.sqrt(sa + sb)).alias("t"), freedom.alias("df"), F.sqrt(sa + sb).alias("standard_error"))


def with_t_p_value(result: DataFrame, center: str | tuple[str, str], confidence: float = 0.95) -> DataFrame:
    """Add the two-sided p-value and the confidence interval to a one-row t-test."""
    spark, row = result.sparkSession, result.first().asDict()
    middle = row[center] if isinstance(center, str) else row[center[0]] - row[center[1]]
    reach = dist.t_quantile(spark, 0.5 + confidence / 2, row["df"]) * row["standard_error"]
    row |= {"p_value": dist.t_two_sided(spark, row["t"], row["df"]), "low": middle - reach, "high": middle + reach}
    return spark.createDataFrame([Row(**row)])


def with_chi_square_p_value(result: DataFrame) -> DataFrame:
    spark, row = result.sparkSession, result.first().asDict()
    row["p_value"] = dist.chi_square_upper(spark, row["statistic"], row["df"])
    return spark.createDataFrame([Row(**row)])


def shape(df: DataFrame, column: str) -> DataFrame:
    """Skewness, excess kurtosis and the Jarque-Bera statistic (chi-square with 2 df)."""
    x = F.col(column).cast("double")
    moments = df.agg(F.count(x).alias("n"), F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"))
    s, k = F.col("skewness"), F.col("kurtosis")
    return moments.select("*", (F.col("n") / 6 * (s * s + k * k / 4)).alias("jarque_bera"))


# Rational approximation of the normal quantile (relative error below 1.2e-9).
CENTRE_TOP = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
              1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
CENTRE_BOTTOM = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
                 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
TAIL_TOP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
TAIL_BOTTOM = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)
TAIL = 0.02425


def _polynomial(x: str, coefficients) -> str:
    out = f"({coefficients[0]:.16e})"
    for c in coefficients[1:]:
        out = f"({out} * {x} + ({c:.16e}))"
    return out


def normal_quantile_sql(p: str) -> str:
    """SQL text of the normal quantile of ``p``."""
    tail = f"sqrt(-2e0 * ln(least({p}, 1e0 - {p})))"
    outer = f"{_polynomial(tail, TAIL_TOP)} / {_polynomial(tail, TAIL_BOTTOM)}"
    q = f"({p} - 5e-1)"
    inner = f"{q} * {_polynomial(f'({q} * {q})', CENTRE_TOP)} / {_polynomial(f'({q} * {q})', CENTRE_BOTTOM)}"
    return f"case when {p} < {TAIL} then {outer} when {p} > {1 - TAIL} then -({outer}) else {inner} end"


def shapiro_wilk(df: DataFrame, column: str, tie_break: str) -> DataFrame:
    """Normality statistic W over all rows, with its p-value where that is tabulated (3 to 5000 rows).

    Rows are ranked by a distributed scan. The weights of the two largest and the two
    smallest values are corrected; the others are the normal scores over a common factor.
    """
    data = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"), F.col(tie_break).alias("_tie"))
    ranked = running(data, ["x", "_tie"], rank="i")
    spark = df.sparkSession
    n = ranked.count()
    if n < 3:
        raise ValueError("at least 3 values are needed")
    scores = ranked.withColumn("p", (F.col("i") - 0.375) / (n + 0.25)).withColumn("m", F.expr(normal_quantile_sql("p")))
    edge = (F.col("i") <= 2) | (F.col("i") >= n - 1) if n > 5 else (F.col("i") == 1) | (F.col("i") == n)
    extreme = scores.filter(edge).select("i", "m", "x").orderBy("i").collect()  # at most four rows
    rest = F.when(~edge, F.col("m") * F.col("x"))
    sums = scores.agg(
        F.sum(F.col("m") * F.col("m")).alias("mm"), F.sum(rest).alias("mx"),
        (F.var_pop("x") * n).alias("ss")).first()
    if not sums["ss"]:
        return spark.createDataFrame([(n, None, None)], "n bigint, w double, p_value double")
    u = 1 / math.sqrt(n)
    root = math.sqrt(sums["mm"])
    top = {r["i"]: r["m"] for r in extreme}
    # Published polynomial corrections of the end weights.
    last = top[n] / root + 0.221157 * u - 0.147981 * u**2 - 2.071190 * u**3 + 4.434685 * u**4 - 2.706056 * u**5
    if n == 3:
        last = math.sqrt(0.5)
    weights = {n: last, 1: -last}
    if n > 5:
        before = top[n - 1] / root + 0.042981 * u - 0.293762 * u**2 - 1.752461 * u**3 + 5.682633 * u**4 - 3.582633 * u**5
        weights |= {n - 1: before, 2: -before}
        factor = (sums["mm"] - 2 * top[n] ** 2 - 2 * top[n - 1] ** 2) / (1 - 2 * last**2 - 2 * before**2)
    else:
        factor = (sums["mm"] - 2 * top[n] ** 2) / (1 - 2 * last**2) if n > 3 else 1.0
    numerator = sum(weights[r["i"]] * r["x"] for r in extreme) + (sums["mx"] or 0.0) / math.sqrt(factor)
    w = min(numerator**2 / sums["ss"], 1.0)
    return spark.createDataFrame([(n, float(w), _shapiro_p(w, n))], "n bigint, w double, p_value double")


def _shapiro_p(w: float, n: int) -> float | None:
    if n > 5000:
        return None
    if n == 3:
        return max(6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))), 0.0)
    if w >= 1:
        return 1.0
    y, x = math.log(1 - w), math.log(n)
    # Published coefficients of the mean and deviation of the transformed statistic.
    if n <= 11:
        y = -math.log(0.459 * n - 2.273 - y)
        mean = 0.5440 - 0.39978 * n + 0.025054 * n**2 - 0.0006714 * n**3
        deviation = math.exp(1.3822 - 0.77857 * n + 0.062767 * n**2 - 0.0020322 * n**3)
    else:
        mean = 0.0038915 * x**3 - 0.083751 * x**2 - 0.31082 * x - 1.5861
        deviation = math.exp(0.0030302 * x**2 - 0.082676 * x - 0.4803)
    return dist.normal_upper((y - mean) / deviation)
