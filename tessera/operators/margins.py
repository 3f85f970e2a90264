"""Linear support vector machine with the squared hinge loss, by Newton steps with conjugate gradients.

The loss is ``|w|^2 / 2 + C sum max(0, 1 - y f(x))^2`` with the intercept as the weight of a constant feature. Rows stay
where they are; a pass gives one vector per task (a gradient, or the Hessian times a direction), and vectors are added
up in two levels, so the driver gets about the square root of the number of tasks. Up to ``FORMED`` weights a pass also sums
the Hessian, and a Newton step is two passes however hard the rows are to separate; beyond, only its products are formed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.session import written

FORMED = 512  # weights up to which the Hessian is a sum of its own: 2 MB a task
STEPS = 2.0 ** -np.arange(12)  # lengths that one pass tries along a direction
Rows = tuple[np.ndarray, np.ndarray]  # features with a constant 1 behind them, signs of the label


def _summed(rows: DataFrame, partial: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``partial(features, signs)``, a vector of ``size`` numbers, over all rows."""
    def total(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for part in parts:
            out += part
        yield pa.RecordBatch.from_pydict({"sum": pa.array([out.tobytes()], pa.binary())})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return total(partial(*_matrix(b)) for b in batches if b.num_rows)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return total(np.frombuffer(p) for b in batches for p in b["sum"].to_pylist())

    parts = rows.mapInArrow(first, "sum binary")
    width = math.isqrt(max(parts.rdd.getNumPartitions(), 1))
    if width > 2:
        parts = parts.repartition(width).mapInArrow(second, "sum binary")
    return sum((np.frombuffer(r["sum"]) for r in parts.collect()), np.zeros(size))


def _matrix(batch: pa.RecordBatch) -> Rows:
    values = batch["values"]
    x = values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.column_stack([x, np.ones(len(x))]), batch["sign"].to_numpy(zero_copy_only=False)


@dataclass
class LinearMargin:
    """``coefficients`` and ``intercept`` of a fitted separation; ``passes`` over the rows that it took."""

    coefficients: np.ndarray
    intercept: float
    passes: int = 0

    def apply(self, df: DataFrame, values: str) -> DataFrame:
        """Add ``predicted``: 1 where the separation is above 0."""
        pairs = F.zip_with(F.col(values), F.lit(self.coefficients.tolist()), lambda a, b: a.cast("double") * b)
        score = F.aggregate(pairs, F.lit(float(self.intercept)), lambda total, x: total + x)
        return df.withColumn("predicted", (score > 0).cast("int"))


def fit(train: DataFrame, values: str, label: str, cost: float = 1.0, max_iterations: int = 100, tolerance: float = 1e-9) -> LinearMargin:
    """Fit on an array column of one length and a label that is 1 or anything else; ``cost`` is C.

    Rows with a null array or label are left out. The steps end when the gradient is below ``tolerance`` times the first one.
    """
    rows = written(train.filter(F.col(values).isNotNull() & F.col(label).isNotNull()).select(
        F.col(values).cast("array<double>").alias("values"), F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("sign")), "rows")
    sizes = rows.agg(F.min(F.size("values")), F.max(F.size("values"))).first()
    if sizes[0] is None or sizes[0] != sizes[1]:
        raise ValueError("there must be rows, with arrays of one length")
    size = sizes[0] + 1
    formed = size <= FORMED
    w, passes, start = np.zeros(size), 0, None
    for _ in range(max_iterations):
        at = w.copy()

        def slope(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            short = np.maximum(1 - y * (x @ at), 0)
            parts = [x.T @ (-2 * cost * y * short), [cost * short @ short]]
            if formed:
                active = x[short > 0]
                parts.append((2 * cost * (active.T @ active)).ravel())
            return np.concatenate(parts)

        found, passes = _summed(rows, slope, size + 1 + formed * size * size), passes + 1
        gradient, loss = found[:size] + w, found[size] + w @ w / 2
        norm = float(np.linalg.norm(gradient))
        start = norm if start is None else start
        if norm <= tolerance * start or norm == 0:
            break

        def curved(direction: np.ndarray) -> np.ndarray:
            def partial(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                active = x[y * (x @ at) < 1]
                return active.T @ (2 * cost * (active @ direction))

            return _summed(rows, partial, size) + direction

        if formed:
            step, used = np.linalg.solve(found[size + 1:].reshape(size, size) + np.eye(size), -gradient), 0
        else:
            step, used = _conjugate(curved, -gradient, min(0.1, math.sqrt(norm / start)) * norm)

        def losses(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            here, along = y * (x @ at), y * (x @ step)
            return np.array([np.sum(np.maximum(1 - here - t * along, 0) ** 2) for t in STEPS]) * cost

        values_at = _summed(rows, losses, len(STEPS)) + np.array([np.sum((w + t * step) ** 2) / 2 for t in STEPS])
        passes += used + 1
        good = values_at <= loss + 1e-4 * STEPS * (gradient @ step)
        if not good.any():
            break  # no length is better in double precision
        w = w + STEPS[int(np.argmax(good))] * step
    return LinearMargin(w[:-1], float(w[-1]), passes)


def _conjugate(product: Callable[[np.ndarray], np.ndarray], target: np.ndarray, close: float) -> tuple[np.ndarray, int]:
    """Solve ``product(x) = target`` up to a remainder of length ``close``; the solution and the number of products."""
    x, rest, way = np.zeros_like(target), target.copy(), target.copy()
    length, used = float(rest @ rest), 0
    while math.sqrt(length) > close and used < 250:
        bent, used = product(way), used + 1
        stride = length / float(way @ bent)
        x += stride * way
        rest -= stride * bent
        before, length = length, float(rest @ rest)
        way = rest + length / before * way
    return x, used
