"""Linear regression from one triangular factor.

``moments`` reads the data once. Every task reduces its rows to the triangular factor of a QR decomposition, and factors
are merged up a tree, so what is left is a matrix whose size depends on the number of terms only. Cross-products are never
formed: they would square the condition number, which a term next to its own square does not bear. Every model
over a subset of the terms, every selection step and every variance inflation factor is then a small decomposition on
the driver. Row-level results are column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions import distributions as dist
from tessera.operators.ordered import lagged
from tessera.session import written


@dataclass
class Fit:
    """One fitted model."""

    terms: dict[str, Column]
    target: Column
    n: int
    coefficients: np.ndarray
    intercept: float
    root: np.ndarray  # inverse of the triangular factor of the centred terms
    means: np.ndarray
    target_mean: float
    rss: float
    tss: float

    @property
    def parameters(self) -> int:
        return len(self.terms) + 1

    @property
    def freedom(self) -> int:
        return self.n - self.parameters

    @property
    def variance(self) -> float:
        return self.rss / self.freedom

    def criterion(self, k: float) -> float:
        """``k`` = 2 gives AIC and ``k`` = ln n gives BIC; the error variance counts as a parameter."""
        return self.n * (math.log(2 * math.pi) + math.log(self.rss / self.n) + 1) + k * (self.parameters + 1)

    @property
    def aic(self) -> float:
        return self.criterion(2)

    @property
    def bic(self) -> float:
        return self.criterion(math.log(self.n))

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss

    def table(self, spark: SparkSession) -> DataFrame:
        errors = math.sqrt(self.variance) * np.linalg.norm(self.root, axis=1)
        first = math.sqrt(self.variance * (1 / self.n + np.sum((self.means @ self.root) ** 2)))
        rows = []
        for name, estimate, error in zip(
            ["(intercept)", *self.terms], [self.intercept, *self.coefficients], [first, *errors]
        ):
            t = float(estimate / error)
            rows.append((name, float(estimate), float(error), t, dist.t_two_sided(spark, t, self.freedom)))
        return spark.createDataFrame(rows, "term string, estimate double, standard_error double, t double, p_value double")

    def summary(self, spark: SparkSession) -> DataFrame:
        p = len(self.terms)
        f = ((self.tss - self.rss) / p) / self.variance
        adjusted = 1 - (self.rss / self.freedom) / (self.tss / (self.n - 1))
        return spark.createDataFrame(
            [(self.n, self.r2, adjusted, math.sqrt(self.variance), f, p, self.freedom,
              dist.f_upper(spark, f, p, self.freedom), self.aic, self.bic)],
            "n bigint, r2 double, adjusted_r2 double, sigma double, f double, df1 int, df2 bigint, p_value double, aic double, bic double")

    def _gaps(self) -> list[Column]:
        return [c.cast("double") - F.lit(float(m)) for c, m in zip(self.terms.values(), self.means)]

    def predicted(self) -> Column:
        return reduce(lambda a, b: a + b, [
            gap * F.lit(float(b)) for gap, b in zip(self._gaps(), self.coefficients)], F.lit(float(self.target_mean)))

    def residual(self) -> Column:
        return self.target.cast("double") - self.predicted()

    def leverage(self) -> Column:
        """Diagonal of the hat matrix."""
        gaps, out = self._gaps(), F.lit(1.0 / self.n)
        for k in range(len(gaps)):
            side = reduce(lambda a, b: a + b, [gaps[i] * F.lit(float(self.root[i, k])) for i in range(k + 1)])
            out = out + side * side
        return out

    def diagnostics(self, df: DataFrame) -> DataFrame:
        """Add prediction, residual, leverage, studentised residual and Cook's distance."""
        e, h = F.col("residual"), F.col("leverage")
        without = (F.lit(self.rss) - e * e / (1 - h)) / F.lit(float(self.freedom - 1))
        return (
            df.withColumns({"predicted": self.predicted(), "residual": self.residual(), "leverage": self.leverage()})
            .withColumn("studentised", F.try_divide(e, F.sqrt(without * (1 - h))))
            .withColumn("cook", e * e * h / (F.lit(self.parameters * self.variance) * (1 - h) * (1 - h)))
        )

    @property
    def leverage_threshold(self) -> float:
        return 2 * self.parameters / self.n

    def with_band(self, df: DataFrame, confidence: float = 0.95) -> DataFrame:
        """Add the expected value and its confidence band to rows of regressors."""
        reach = dist.t_quantile(df.sparkSession, 0.5 + confidence / 2, self.freedom)
        error = F.sqrt(self.leverage() * F.lit(self.variance))
        return df.withColumn("predicted", self.predicted()).withColumn("standard_error", error).withColumn(
            "low", F.col("predicted") - F.col("standard_error") * reach).withColumn(
            "high", F.col("predicted") + F.col("standard_error") * reach)


@dataclass
class Moments:
    """Count, means and the triangular factor of all centred candidate terms and the target."""

    terms: dict[str, Column]
    target: Column
    n: int
    mean: np.ndarray
    factor: np.ndarray  # the last column belongs to the target
    size: np.ndarray  # length of each column before centring

    def _root(self, at: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
        """Inverse factor of the chosen terms, the target's part along them, and the length of the rest."""
        columns = self.factor[:, at]
        scale = np.linalg.norm(columns, axis=0)
        if np.any(scale <= 1e-13 * self.size[at]):
            raise ValueError("a term is constant")
        small = np.linalg.qr(np.column_stack([columns / scale, self.factor[:, -1]]), mode="r")
        k = len(at)
        return np.linalg.inv(small[:k, :k]) / scale[:, None], small[:k, k], float(np.linalg.norm(small[k:, k]))

    def fit(self, names: Sequence[str] | None = None) -> Fit:
        names = list(self.terms) if names is None else list(names)
        at = [list(self.terms).index(name) for name in names]
        root, along, rest = self._root(at)
        beta, means = root @ along, self.mean[at]
        return Fit(
            terms={name: self.terms[name] for name in names}, target=self.target, n=self.n, coefficients=beta,
            intercept=float(self.mean[-1] - means @ beta), root=root, means=means, target_mean=float(self.mean[-1]),
            rss=rest ** 2, tss=float(np.sum(self.factor[:, -1] ** 2)))

    def without(self, *dropped: str) -> Fit:
        return self.fit([name for name in self.terms if name not in dropped])

    def inflation(self, names: Sequence[str] | None = None) -> dict[str, float]:
        """Variance inflation factors: squared lengths of the scaled inverse factor's rows."""
        names = list(self.terms) if names is None else list(names)
        at = [list(self.terms).index(name) for name in names]
        scale = np.linalg.norm(self.factor[:, at], axis=0)
        return dict(zip(names, ((np.linalg.norm(self._root(at)[0], axis=1) * scale) ** 2).tolist()))

    def compare(self, spark: SparkSession, models: Mapping[str, Sequence[str]]) -> DataFrame:
        rows = []
        for name, chosen in models.items():
            fit = self.fit(chosen)
            rows.append((name, fit.parameters, fit.r2, fit.aic, fit.bic))
        return spark.createDataFrame(rows, "model string, parameters int, r2 double, aic double, bic double")

    def step(self, k: float | None = None) -> Fit:
        """Add or drop one term at a time while ``n ln(RSS/n) + k p`` falls; ``k`` = ln n by default."""
        k = math.log(self.n) if k is None else k
        chosen = list(self.terms)

        def score(names):
            fit = self.fit(names)
            return fit.n * math.log(max(fit.rss, 1e-300) / fit.n) + k * fit.parameters

        best = score(chosen)
        while True:
            moves = [[c for c in chosen if c != name] for name in chosen]
            moves += [chosen + [name] for name in self.terms if name not in chosen]
            value, move = min(((score(m), m) for m in moves), key=lambda pair: pair[0])
            if value >= best - 1e-9:
                return self.fit(chosen)
            best, chosen = value, move


def moments(df: DataFrame, target: Column, terms: Mapping[str, Column]) -> Moments:
    """The one pass over the data. Rows with a missing value in any term are left out."""
    columns = [F.lit(1.0), *terms.values(), target]
    names = [f"v{i}" for i in range(len(columns))]
    data = df.select(*[c.cast("double").alias(v) for c, v in zip(columns, names)]).na.drop()
    parts = data.mapInArrow(lambda batches: _factor(np.column_stack(
        [b[v].to_numpy(zero_copy_only=False) for v in names]) for b in batches), "n bigint, factor binary")
    width = math.isqrt(max(parts.rdd.getNumPartitions(), 1))
    if width > 2:
        parts = parts.repartition(width).mapInArrow(
            lambda batches: _merged([r for b in batches for r in b.to_pylist()], len(names)), "n bigint, factor binary")
    rows = [r.asDict() for r in parts.collect()]
    n = sum(r["n"] for r in rows)
    if not n:
        raise ValueError("no complete rows")
    whole = _triangle([_unpacked(r["factor"], len(names)) for r in rows])
    return Moments(dict(terms), target, n, whole[0, 1:] / whole[0, 0], whole[1:, 1:], np.linalg.norm(whole[:, 1:], axis=0))


def _triangle(blocks: Sequence[np.ndarray]) -> np.ndarray:
    """The square triangular factor of blocks of rows, with rows of 0 where there are too few."""
    stacked = np.vstack(blocks)
    found = np.linalg.qr(stacked, mode="r")
    return np.vstack([found, np.zeros((max(stacked.shape[1] - len(found), 0), stacked.shape[1]))])


def _unpacked(factor: bytes, size: int) -> np.ndarray:
    return np.frombuffer(factor).reshape(-1, size)


def _row(n: int, factor: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "factor": pa.array([factor.tobytes()], pa.binary())})


def _factor(matrices: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    n, factor = 0, None
    for rows in matrices:
        if len(rows):
            n, factor = n + len(rows), _triangle([rows] if factor is None else [factor, rows])
    if n:
        yield _row(n, factor)


def _merged(rows: list[dict], size: int) -> Iterator[pa.RecordBatch]:
    if rows:
        yield _row(sum(r["n"] for r in rows), _triangle([_unpacked(r["factor"], size) for r in rows]))


def dummies(column: str, levels: Sequence[str]) -> dict[str, Column]:
    """0/1 columns of every level but the first, which is the baseline."""
    return {f"{column}={level}": (F.col(column) == F.lit(level)).cast("double") for level in levels[1:]}


def breusch_pagan(df: DataFrame, fit: Fit) -> DataFrame:
    """Studentised heteroskedasticity statistic ``n R^2`` of the squared residuals on the terms."""
    e = fit.residual()
    second = moments(df, e * e, fit.terms).fit()
    spark = df.sparkSession
    statistic, freedom = second.n * second.r2, len(fit.terms)
    return spark.createDataFrame(
        [(statistic, freedom, dist.chi_square_upper(spark, statistic, freedom))], "statistic double, df int, p_value double")


def durbin_watson(df: DataFrame, fit: Fit, order: Sequence[str], exact_below: int = 100) -> DataFrame:
    """Autocorrelation of residuals over an explicit total order: ``d``, its mean and deviation, and a p-value.

    The mean and the deviation of ``d`` under independence are exact; they follow from first and second differences of
    the terms, which are summed in the same pass as those of the residuals. The p-value against positive
    autocorrelation comes from the normal law with these. Samples of fewer than ``exact_below`` rows, the limit of the
    usual implementation, get the exact law of the ratio of quadratic forms.
    """
    gaps, p = fit._gaps(), len(fit.terms)
    # terms made orthogonal and of unit length
    axes = [reduce(lambda a, b: a + b, [gaps[i] * F.lit(float(fit.root[i, k])) for i in range(k + 1)]) for k in range(p)]
    names = ["e", *[f"z{k}" for k in range(p)]]
    rows = df.select(*order, *[c.alias(n) for c, n in zip([fit.residual(), *axes], names)]).filter("e is not null")
    pairs = written(lagged(rows, order, {f"{n}_{k}": (n, k) for n in names for k in (1, 2)}), "pairs")
    first = {n: F.col(n) - F.col(f"{n}_1") for n in names}
    second = {n: F.col(n) - 2 * F.col(f"{n}_1") + F.col(f"{n}_2") for n in names}
    cells = [(i, j) for i in range(p) for j in range(i, p)]
    place = F.when(F.col("e_1").isNotNull(), F.struct(*order))
    steps = F.array(*[first[f"z{k}"] for k in range(p)])
    row = pairs.agg(
        F.count("e").alias("n"), F.sum(first["e"] ** 2).alias("step"), F.sum(F.col("e") * F.col("e")).alias("length"),
        F.min_by(steps, place).alias("head"), F.max_by(steps, place).alias("tail"),
        *[F.sum(first[f"z{i}"] * first[f"z{j}"]).alias(f"a{i}_{j}") for i, j in cells],
        *[F.sum(second[f"z{i}"] * second[f"z{j}"]).alias(f"b{i}_{j}") for i, j in cells]).first()
    n, freedom = row["n"], row["n"] - p - 1
    if n < 3 or not row["length"] or freedom < 1:
        return df.sparkSession.createDataFrame([(None,) * 4], "d double, mean double, sd double, p_value double")
    once, twice = np.zeros((p, p)), np.zeros((p, p))
    for i, j in cells:
        once[i, j] = once[j, i] = row[f"a{i}_{j}"] or 0.0
        twice[i, j] = twice[j, i] = row[f"b{i}_{j}"] or 0.0
    for end in (row["head"], row["tail"]):  # the outermost rows have one neighbour
        twice += np.outer(end, end)
    d = row["step"] / row["length"]
    trace = 2 * (n - 1) - np.trace(once)
    squares = 2 * (3 * n - 4) - 2 * np.trace(twice) + np.sum(once * once)
    mean = float(trace / freedom)
    sd = math.sqrt(max(2 * (squares - trace * mean) / (freedom * (freedom + 2)), 0.0))
    if n < exact_below:
        table = np.array([[r[name] for name in names[1:]] for r in rows.orderBy(*order).select(*names[1:]).collect()]).reshape(n, p)
        basis = np.column_stack([np.full(n, n ** -0.5), table])
        rest = np.eye(n) - basis @ basis.T
        steps = np.diff(rest, axis=0)
        below = dist.ratio_below(np.sort(np.linalg.eigvalsh(steps.T @ steps))[p + 1:], d)
    else:
        below = dist.normal_upper((mean - d) / sd) if sd else None
    return df.sparkSession.createDataFrame([(float(d), mean, sd, below)], "d double, mean double, sd double, p_value double")


def mean_filled(
    df: DataFrame, columns: Sequence[str], given: Mapping[str, float | str], factors: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row of regressors: the given values, the mean of the other numbers (missing values ignored), and the
    baseline (the first level) of the other ``factors``, which map a text column to its levels."""
    factors = factors or {}

    def value(column: str) -> Column:
        if column in factors:
            level = given.get(column, factors[column][0])
            if level not in factors[column]:
                raise ValueError(f"{column} has no level {level}")
            return F.lit(level)
        return F.lit(float(given[column])) if column in given else F.avg(column)

    return df.agg(*[value(c).alias(c) for c in columns])


def effect_curve(
    df: DataFrame, fit: Fit, columns: Sequence[str], varied: str, values: Sequence[float | str],
    given: Mapping[str, float | str] | None = None, factors: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Expected value with its band over a range of one column (for a factor: over levels), the others given, at
    their means or at their baseline; see ``mean_filled``."""
    factors, others = factors or {}, [c for c in columns if c != varied]
    base = mean_filled(df, others, given or {}, factors) if others else df.sparkSession.range(1).drop("id")
    entries = [F.lit(v if varied in factors else float(v)) for v in values]
    grid = base.withColumn(varied, F.explode(F.array(*entries)))
    return fit.with_band(grid).select(varied, "predicted", "standard_error", "low", "high")
