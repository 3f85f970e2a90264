"""Tail probabilities for test statistics, evaluated on already aggregated numbers."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import SparkSession


def _family(spark: SparkSession):
    return spark._jvm.org.apache.commons.math3.distribution


def t_two_sided(spark: SparkSession, t: float, df: float) -> float | None:
    if t is None or df is None or math.isnan(t) or df <= 0:
        return None
    return 2.0 * _family(spark).TDistribution(float(df)).cumulativeProbability(-abs(float(t)))


def t_quantile(spark: SparkSession, p: float, df: float) -> float:
    return _family(spark).TDistribution(float(df)).inverseCumulativeProbability(float(p))


def chi_square_upper(spark: SparkSession, x: float, df: float) -> float | None:
    if x is None or df is None or df <= 0:
        return None
    return 1.0 - _family(spark).ChiSquaredDistribution(float(df)).cumulativeProbability(float(x))


def f_upper(spark: SparkSession, x: float, df1: float, df2: float) -> float | None:
    if x is None or df1 <= 0 or df2 <= 0:
        return None
    return 1.0 - _family(spark).FDistribution(float(df1), float(df2)).cumulativeProbability(float(x))


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def ratio_below(values: np.ndarray, x: float) -> float:
    """P(sum v_i Z_i^2 < x sum Z_i^2) for independent standard normal Z.

    Numerical inversion of the characteristic function of ``sum (v_i - x) Z_i^2`` (Imhof's integral), by
    Gauss-Legendre rules on panels whose ends double, until what is left cannot matter.
    """
    a = np.asarray(values, float) - x
    scale = np.abs(a).max(initial=0.0)
    if scale == 0 or a.min() >= 0:
        return 0.0
    if a.max() <= 0:
        return 1.0
    a = a[np.abs(a) > 1e-15 * scale] / scale
    nodes, weights = np.polynomial.legendre.leggauss(64)
    total, low, width = 0.0, 0.0, 0.25
    while True:
        u = low + width * (nodes + 1) / 2
        angle = 0.5 * np.arctan(np.outer(u, a)).sum(axis=1)
        shrunk = np.exp(-0.25 * np.log1p(np.outer(u, a) ** 2).sum(axis=1))
        total += float(width / 2 * weights @ (np.sin(angle) / u * shrunk))
        low, last = low + width, shrunk[-1]
        if last < 1e-13 or low > 1e9:
            break
        width = min(low, 4.0) if len(a) > 2 else low  # the angle turns by a quarter for each value at most
    return min(max(0.5 - total / math.pi, 0.0), 1.0)
