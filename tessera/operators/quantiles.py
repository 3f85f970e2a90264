"""Exact percentiles, moments and box statistics with two reads of the data.

The first read makes means and a rank-bounded quantile sketch of every column and group; partial sketches merge, so no
task sees a group. The sketch gives for each percentile two values that are certain to enclose it. The second read turns every
value into an entry: a value inside an enclosure stays as it is, any other becomes the gap it lies in. Equal entries are
counted before anything is shuffled, so what leaves the tasks is one row per gap and the few values that matter. Ranks
are running sums over these entries, spread over range partitions like any other. Power sums of the
distances from a middle value, which the sketch knows too, go with the entries and give the other moments.

The fences of a box plot have enclosures too, from those of the quartiles. No gap reaches over a fence, and gaps know
their least and greatest value, so whiskers and outliers need no further read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.ordered import running
from tessera.session import written

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
MOMENTS = ("n", "min", "mean", "max", "sd", "skewness", "kurtosis")


class Ranked:
    """What two reads tell about the columns of a table: ``groups`` (one row per group and variable) and ``entries``.

    With ``fence`` (a multiple of the quartile distance) the probabilities must be those of ``QUARTILES``. A null is no
    value; a group without values has no entries.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], by: Sequence[str] = (),
                 accuracy: int = 10_000, fence: float | None = None):
        self.by, self.columns, self.probabilities = list(by), list(columns), dict(probabilities)
        self.fence = fence
        self.keys = [f"_g{i}" for i in range(len(self.by))]
        self.inside = [f"_v{i}" for i in range(len(self.columns))]
        numeric = df.select(*[F.col(b).alias(g) for b, g in zip(self.by, self.keys)],
                            *[F.col(c).cast("double").alias(v) for c, v in zip(self.columns, self.inside)])
        self.places = len(self.probabilities) + (0 if fence is None else 2)
        limits = written(self._first_read(numeric, accuracy), "sketch")
        self.groups = limits.select(*self.keys, F.posexplode(F.array(*[
            F.struct(F.col(f"_size{i}").alias("size"), F.col(f"_mean{i}").alias("mean")) for i in range(len(self.inside))
        ])).alias("_variable", "_e")).select(*self.keys, "_variable", "_e.size", "_e.mean")
        self.entries = self._second_read(numeric, limits)

    def _first_read(self, numeric: DataFrame, accuracy: int) -> DataFrame:
        """Sizes, middle values and the ends of all enclosures, one row per group."""
        probs, margin, fence = list(self.probabilities.values()), 3.0 / accuracy, self.fence
        edges = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
        sketch = numeric.groupBy(*self.keys).agg(*[
            F.struct(F.count(v).alias("size"), F.avg(v).alias("mean"), F.percentile_approx(v, edges, accuracy).alias("edges")).alias(f"_s{i}")
            for i, v in enumerate(self.inside)])

        def enclosures(i: int) -> list[Column]:
            size, found = F.col(f"_s{i}.size"), F.col(f"_s{i}.edges")
            tiny = size * margin < 3  # the margin must be worth at least three ranks; a smaller group is taken whole
            low = [F.when(tiny, F.lit(float("-inf"))).otherwise(found[j]) for j in range(len(probs))]
            high = [F.when(tiny, F.lit(float("inf"))).otherwise(found[j + len(probs)]) for j in range(len(probs))]
            if fence is not None:
                first, last = 0, len(probs) - 1
                low += [low[first] - fence * (high[last] - low[first]), low[last] + fence * (low[last] - high[first])]
                high += [high[first] - fence * (low[last] - high[first]), high[last] + fence * (high[last] - low[first])]
            return [size.alias(f"_size{i}"), F.col(f"_s{i}.mean").alias(f"_mean{i}"), found[len(probs) // 2].alias(f"_middle{i}"),
                    *[x.alias(f"_low{i}_{j}") for j, x in enumerate(low)], *[x.alias(f"_high{i}_{j}") for j, x in enumerate(high)]]

        return sketch.select(*self.keys, *[c for i in range(len(self.inside)) for c in enclosures(i)])

    def _second_read(self, numeric: DataFrame, limits: DataFrame) -> DataFrame:
        if self.keys:
            edges = limits.select(*[F.col(c).alias(f"_of{c}" if c in self.keys else c) for c in limits.columns])
            side = F.broadcast(edges) if limits.count() <= 100_000 else edges
            rows = numeric.join(side, reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_of{g}")) for g in self.keys]))
            edge = F.col
        else:
            rows, known = numeric, limits.first().asDict()  # one row
            edge = lambda name: F.lit(known[name]).cast("double")

        def entry(i: int, v: str) -> Column:
            x = F.col(v)
            low, high = ([edge(f"_{side}{i}_{j}") for j in range(self.places)] for side in ("low", "high"))
            within = reduce(lambda a, b: a | b, [x.between(a, b) for a, b in zip(low, high)])
            below = F.greatest(F.lit(float("-inf")), *[F.when(b < x, b) for b in high])
            return F.when(x.isNotNull(), F.struct(
                F.lit(i).alias("_variable"), F.when(within, x).otherwise(below).alias("value"), (~within).alias("gap"), x.alias("x"),
                (x - edge(f"_middle{i}")).alias("d")))

        d = F.col("d")
        entries = rows.select(*self.keys, F.explode(F.array(*[entry(i, v) for i, v in enumerate(self.inside)])).alias("_e"))
        counted = written(
            entries.filter("_e is not null").select(*self.keys, "_e.*").groupBy(*self.keys, "_variable", "value", "gap").agg(
                F.count(F.lit(1)).alias("n"), F.min("x").alias("least"), F.max("x").alias("greatest"),
                F.sum(d).alias("d1"), F.sum(d * d).alias("d2"), F.sum(d * d * d).alias("d3"), F.sum(d * d * d * d).alias("d4")),
            "entries")
        return running(counted, ["value", "gap"], [*self.keys, "_variable"], sums={"upto": "n"})

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_of{k}"]) for k in [*self.keys, "_variable"]])

    def _renamed(self, df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_of{k}") for k in [*self.keys, "_variable"]], *columns)

    def percentiles(self) -> DataFrame:
        """Keys, ``_variable`` and the linearly interpolated percentiles, for groups with values."""
        sizes = self._renamed(self.groups, "size")
        placed = self.entries.filter("not gap").join(sizes, self._same(self.entries, sizes))

        def at(target: Column) -> Column:
            return F.max(F.when((target >= F.col("upto") - F.col("n")) & (target < F.col("upto")), F.col("value")))

        position = {name: (F.col("size") - 1) * F.lit(float(p)) for name, p in self.probabilities.items()}
        found = placed.groupBy(*self.keys, "_variable").agg(*[
            F.struct(at(F.floor(t)).alias("low"), at(F.ceil(t)).alias("high"), F.first(t - F.floor(t)).alias("part")).alias(name)
            for name, t in position.items()])
        return found.select(*self.keys, "_variable", *[
            (F.col(f"{name}.low") + F.col(f"{name}.part") * (F.col(f"{name}.high") - F.col(f"{name}.low"))).alias(name)
            for name in self.probabilities])

    def moments(self) -> DataFrame:
        """Keys, ``_variable``, count, range, mean, sample deviation, skewness and excess kurtosis, for every group."""
        sums = self.entries.groupBy(*self.keys, "_variable").agg(
            F.min("least").alias("min"), F.max("greatest").alias("max"), *[F.sum(f"d{k}").alias(f"d{k}") for k in (1, 2, 3, 4)])
        sums = self._renamed(sums, "min", "max", "d1", "d2", "d3", "d4")
        joined = self.groups.join(sums, self._same(self.groups, sums), "left")
        n = F.col("size")
        a, b, c, e = (F.col(f"d{k}") / n for k in (1, 2, 3, 4))
        m2 = F.greatest(b - a * a, F.lit(0.0))
        m3, m4 = c - 3 * a * b + 2 * a * a * a, e - 4 * a * c + 6 * a * a * b - 3 * a * a * a * a
        varies = m2 > 0
        return joined.select(
            *self.keys, "_variable", n.alias("n"), "min", "mean", "max",
            F.when(n > 1, F.sqrt(m2 * n / (n - 1))).alias("sd"), F.when(varies, m3 / F.pow(m2, F.lit(1.5))).alias("skewness"),
            F.when(varies, m4 / (m2 * m2) - 3).alias("kurtosis"))

    def boxes(self) -> DataFrame:
        """Keys, ``_variable``, quartiles, count, furthest values within the fences and the number of values beyond."""
        quartiles = self._renamed(self.percentiles(), *QUARTILES)
        joined = self.entries.join(quartiles, self._same(self.entries, quartiles))
        reach = self.fence * (F.col("q3") - F.col("q1"))
        inside = F.col("least").between(F.col("q1") - reach, F.col("q3") + reach)
        return joined.groupBy(*self.keys, "_variable", *QUARTILES).agg(
            F.sum("n").alias("n"), F.min(F.when(inside, F.col("least"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("greatest"))).alias("high_whisker"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"))

    def named(self, df: DataFrame, *columns: str | Column) -> DataFrame:
        """``df`` with the names of the groups and variables."""
        variable = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("_variable") + 1)
        return df.select(*[F.col(g).alias(b) for b, g in zip(self.by, self.keys)], variable.alias("variable"), *columns)


def percentiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], by: Sequence[str] = (),
                accuracy: int = 10_000) -> DataFrame:
    """Exact linearly interpolated percentiles, long form: ``by..., variable, <names>``; none for groups without values."""
    ranked = Ranked(df, columns, probabilities, by, accuracy)
    return ranked.named(ranked.percentiles(), *probabilities)


def summary(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Quartiles and moments, long form: ``by..., variable, <MOMENTS>, q1, median, q3``."""
    ranked = Ranked(df, columns, QUARTILES, by, accuracy)
    quartiles = ranked._renamed(ranked.percentiles(), *QUARTILES)
    moments = ranked.moments()
    return ranked.named(moments.join(quartiles, ranked._same(moments, quartiles), "left"), *MOMENTS, *QUARTILES)
