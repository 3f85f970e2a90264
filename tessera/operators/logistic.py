"""Penalised logistic regression on sparse rows, by Newton steps with conjugate gradients.

The loss is ``|w|^2 / 2`` plus the sum of the log losses; the intercept, the weight of a constant behind the features, is
not penalised. Rows are packed once into blocks of arrays, each with the list of its own features, so that a pass works
in small arrays; tasks read the written blocks by themselves, since Spark took longer to hand them over than a pass to
work on them. A pass gives one vector per task, and there are no more tasks than cores; if these are too large for the
driver, they are added up in two levels. The driver has a few numbers per feature.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.session import written

BLOCK = 1 << 19  # entries of a block, of whole rows
DIRECT = 128 << 20  # bytes of all tasks' vectors that the driver adds up by itself
BLOCKS = "labels binary, starts binary, features binary, places binary, weights binary"


@dataclass
class Logistic:
    """``coefficients`` and ``intercept`` of a fit; ``passes`` over the rows that it took and the steepest mean ``slope`` left."""

    coefficients: DenseVector
    intercept: float
    passes: int = 0
    slope: float = 0.0

    def score(self, df: DataFrame, entries: str, score: str) -> DataFrame:
        """Add the probability of label 1 of rows whose ``entries`` are a struct of ``indices`` and ``values``."""
        spark = df.sparkSession
        shared = spark.sparkContext.broadcast(np.append(self.coefficients.toArray(), self.intercept))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, starts, places, weights = _entries(batch[entries], len(shared.value) - 1)
                found = _chance(np.add.reduceat(weights * shared.value[places], starts)) if len(starts) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, score])

        return df.mapInArrow(work, df.withColumn(score, F.lit(0.0)).schema)


def _chance(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-margin))


def _entries(column: pa.StructArray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of entries and start of each row, feature and value of each entry; a row's last entry is the constant 1."""
    lists, values = column.field("indices"), column.field("values")
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    ends = np.cumsum(lengths)
    places = np.insert(lists.flatten().to_numpy(), ends, size)
    return lengths + 1, ends - lengths + np.arange(len(lengths)), places, np.insert(values.flatten().to_numpy(), ends, 1.0)


def _packed(rows: DataFrame, entries: str, label: str, size: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, starts, places, weights = _entries(batch[entries], size)
            labels = batch[label].to_numpy(zero_copy_only=False).astype(np.float64)
            cuts = np.flatnonzero(np.diff(starts // BLOCK)) + 1
            for first, end in zip([0, *cuts], [*cuts, len(lengths)]):
                if first == end:
                    continue
                here = slice(starts[first], starts[end - 1] + lengths[end - 1])
                features, local = np.unique(places[here], return_inverse=True)
                parts = (labels[first:end], (starts[first:end] - starts[first]).astype(np.int32), features.astype(np.int32),
                         local.astype(np.int32), weights[here])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.tobytes()], pa.binary()) for part in parts], [f.split()[0] for f in BLOCKS.split(", ")])

    return written(rows.mapInArrow(work, BLOCKS), "blocks")


def _blocks(files: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """Labels, starts of rows, features, and of each entry its place among the features and its weight."""
    for file in files:
        store, path = fs.FileSystem.from_uri(file)
        with store.open_input_file(path) as source:
            for batch in pq.ParquetFile(source, buffer_size=1 << 20).iter_batches(batch_size=1):
                labels, starts, features, places, weights = (c[0].as_buffer() for c in batch.columns)
                yield (np.frombuffer(labels), np.frombuffer(starts, np.int32), np.frombuffer(features, np.int32),
                       np.frombuffer(places, np.int32), np.frombuffer(weights))


def _summed(spark: SparkSession, files: list[str], partial: Callable[..., None], given: np.ndarray, size: int) -> np.ndarray:
    """The sum of what ``partial(out, given, *block)`` adds to ``out``, a vector of ``size`` numbers, over all blocks."""
    shared = spark.sparkContext.broadcast(given)
    tasks = min(spark.sparkContext.defaultParallelism, len(files))

    def total(out: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"sum": pa.array([out.tobytes()], pa.binary())})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch["id"].to_pylist():
                out = np.zeros(size)
                for block in _blocks(files[task::tasks]):
                    partial(out, shared.value, *block)
                yield total(out)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            for part in batch["sum"]:
                out += np.frombuffer(part.as_buffer())
        yield total(out)

    parts = spark.range(0, tasks, 1, tasks).mapInArrow(first, "sum binary")
    if tasks * size * 8 > DIRECT and tasks > 8:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(second, "sum binary")
    try:
        out = np.zeros(size)
        for part in parts.toArrow()["sum"]:
            out += np.frombuffer(part.as_buffer())
        return out
    finally:
        shared.destroy()


def _slope(out, w, labels, starts, features, places, weights):
    """Gradient, loss and summed curvature."""
    margin = np.add.reduceat(weights * w[features][places], starts)
    chance = _chance(margin)
    pull = np.repeat(chance - labels, np.diff(starts, append=len(places)))
    out[features] += np.bincount(places, weights * pull, len(features))
    out[-2] += np.logaddexp(0, np.where(labels == 1, -margin, margin)).sum()
    out[-1] += (chance * (1 - chance)).sum()


def _curved(out, both, labels, starts, features, places, weights):
    """The Hessian times a direction; ``both`` has the weights as real and the direction as imaginary parts."""
    found = np.add.reduceat(weights * both[features][places], starts)
    chance = _chance(found.real)
    pull = np.repeat(chance * (1 - chance) * found.imag, np.diff(starts, append=len(places)))
    out[features] += np.bincount(places, weights * pull, len(features))


def fit(rows: DataFrame, entries: str, label: str, size: int, max_passes: int, tolerance: float = 1e-9) -> Logistic:
    """Fit on rows whose ``entries`` are a struct of ``indices`` and ``values``, and on a label of 0 or 1.

    The steps end when the mean loss has no slope above ``tolerance`` along any weight, or after ``max_passes``.
    """
    found = rows.agg(F.count(F.lit(1)), F.sum(label)).first()
    n, ones = int(found[0]), float(found[1] or 0)
    if ones in (0, n):
        return Logistic(DenseVector(np.zeros(size)), math.inf if ones else -math.inf)
    spark, files = rows.sparkSession, sorted(_packed(rows, entries, label, size).inputFiles())
    penalty = np.append(np.ones(size), 0.0)
    w, passes = np.append(np.zeros(size), math.log(ones / (n - ones))), 1

    def at(w: np.ndarray) -> tuple[np.ndarray, float, float]:
        out = _summed(spark, files, _slope, w, size + 3)
        out[:size + 1] += penalty * w
        return out[:size + 1], out[-2] + float(penalty * w @ w) / 2, out[-1]

    gradient, loss, curvature = at(w)
    while (steepest := float(np.abs(gradient).max()) / n) > tolerance and passes < max_passes:
        scale = np.append(np.ones(size), max(curvature, 1e-12))

        def product(way: np.ndarray) -> np.ndarray:
            return _summed(spark, files, _curved, w + 1j * way, size + 1) + penalty * way

        step, used = _conjugate(product, -gradient, scale, n, tolerance, max_passes - passes)
        passes += used
        along, length = float(gradient @ step), 1.0
        while True:
            there = at(w + length * step)
            passes += 1
            if there[1] <= loss + 1e-4 * length * along + 1e-12 * abs(loss) or length < 1e-6:
                break
            length /= 2
        w, (gradient, loss, curvature) = w + length * step, there
    return Logistic(DenseVector(w[:-1]), float(w[-1]), passes, steepest)


def _conjugate(
    product: Callable[[np.ndarray], np.ndarray], target: np.ndarray, scale: np.ndarray, n: int, tolerance: float, most: int,
) -> tuple[np.ndarray, int]:
    """Solve ``product(x) = target`` the closer the smaller the target; the solution and the number of products."""
    x, rest, used = np.zeros_like(target), target.copy(), 0
    scaled = rest / scale
    way, length = scaled.copy(), float(rest @ scaled)
    close = length * min(0.1, math.sqrt(10 * math.sqrt(length) / n)) ** 2
    while used < max(most, 1):
        bent, used = product(way), used + 1
        stride = length / float(way @ bent)
        x += stride * way
        rest -= stride * bent
        scaled = rest / scale
        before, length = length, float(rest @ scaled)
        if length <= close or np.abs(rest).max() <= 0.3 * tolerance * n:
            break
        way = scaled + length / before * way
    return x, used
