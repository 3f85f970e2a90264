"""Descriptive statistics, box statistics, frequency tables, correlation and density."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.scalar import safe_ratio
from tessera.operators.ordered import running
from tessera.operators.quantiles import QUARTILES, Ranked, percentiles, summary

FENCE = 1.5  # quartile distances from the box to its fences


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Location, spread and shape. Kurtosis is the excess over a normal; sd is the sample one."""
    return summary(df, columns, by).select(
        *by, "variable", "n", "min", "q1", "median", "mean", "q3", "max", "sd",
        (F.col("q3") - F.col("q1")).alias("iqr"),
        (safe_ratio(F.col("sd"), F.col("mean")) * 100).alias("cv_percent"), "skewness", "kurtosis",
    )


def five_numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return summary(df, columns, by).select(
        *by, "variable", "min", "q1", "median", "mean", "q3", "max")


def box_statistics(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR of the box) and outlier counts."""
    ranked = Ranked(df, [column], QUARTILES, by, fence=FENCE)
    kind = df.schema[column].dataType
    return ranked.named(ranked.boxes(), *QUARTILES, "n", *[
        F.col(name).cast(kind).alias(name) for name in ("low_whisker", "high_whisker")], "outliers").drop("variable")


def _fenced(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    if not by:
        raise ValueError("name at least one grouping column")
    quartiles = percentiles(df, [column], QUARTILES, by)
    renamed = quartiles.select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)], *QUARTILES)
    reach = FENCE * (F.col("q3") - F.col("q1"))
    joined = df.join(renamed, [df[b].eqNullSafe(renamed[f"_k{i}"]) for i, b in enumerate(by)])
    return joined.withColumn(
        "_inside", F.col(column).between(F.col("q1") - reach, F.col("q3") + reach))


def outliers(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    return _fenced(df, column, by).filter(~F.col("_inside")).select(*df.columns)


def frequency_table(df: DataFrame, key: str) -> DataFrame:
    """Absolute, relative and cumulative frequencies in key order."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    scanned = running(counts, [F.asc_nulls_first(key)], sums={"cumulative_n": "n"})
    total = scanned.agg(F.max("cumulative_n")).scalar()
    return scanned.select(
        key, "n", (F.col("n") / total).alias("share"), "cumulative_n",
        (F.col("cumulative_n") / total).alias("cumulative_share"))


def gini_heterogeneity(df: DataFrame, column: str, classes: int | None = None) -> DataFrame:
    """Normalised heterogeneity ``(1 - sum f^2) / ((J-1)/J)``.

    ``classes`` is J when some classes may be empty; otherwise J is the observed count.
    Rows without a class stay in the denominator of ``f``.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = counts.agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col(column).isNotNull(), F.col("n") * F.col("n"))).alias("squares"),
        F.count(column).alias("observed"))
    j = F.lit(classes).cast("double") if classes is not None else F.col("observed").cast("double")
    g = 1 - safe_ratio(F.col("squares"), F.col("total") * F.col("total"))
    return sums.select(j.cast("long").alias("classes"), safe_ratio(g, safe_ratio(j - 1, j)).alias("gini"))


def period_totals(df: DataFrame, period: str, value: Column) -> DataFrame:
    return df.groupBy(period).agg(F.sum(value).alias("total"), F.avg(value).alias("mean")).orderBy(period)


def seasonal_profile(df: DataFrame, entity: str, entities: Sequence[object], season: str, value: Column) -> DataFrame:
    return df.filter(F.col(entity).isin(list(entities))).groupBy(entity, season).agg(
        F.sum(value).alias("total"), F.avg(value).alias("mean"))


def contingency(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of each pair and their share of the row total."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(row).alias("_row")).agg(F.sum("n").alias("_total"))
    return counts.join(totals, counts[row].eqNullSafe(totals["_row"])).select(
        row, column, "n", (F.col("n") / F.col("_total")).alias("row_share"))


def label_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Positives per label, most frequent first, and the rows without any label."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in labels), F.lit(0))
    entries = [F.struct(F.lit(c).alias("label"), F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("positives")) for c in labels]
    entries.append(F.struct(F.lit("(none)").alias("label"), F.count_if(total == 0).alias("positives")))
    return df.agg(F.array(*entries).alias("_l")).select(F.inline("_l")).orderBy(F.desc("positives"), "label")


def class_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each class as a fraction."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(column, "n", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"))


def class_weights(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Negatives per positive of each label; null when a label has no positives."""
    entries = [
        F.struct(F.lit(c).alias("label"),
                 safe_ratio((F.count(c) - F.sum(c)).cast("double"), F.sum(c).cast("double")).alias("weight"))
        for c in labels
    ]
    return df.agg(F.array(*entries).alias("_w")).select(F.inline("_w"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all pairs in one pass."""
    def pair(a, b):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        r = F.corr(x, y)
        return F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), r.alias("r"), F.abs(r).alias("abs_r"))

    return df.agg(F.array(*[pair(a, b) for a, b in combinations(columns, 2)]).alias("_c")).select(F.inline("_c"))


def histogram(
    df: DataFrame, value: Column, low: float, high: float, bins: int, weight: Column | None = None,
    by: Sequence[str] = (), right_closed: bool = False,
) -> DataFrame:
    """Counts (or weights) in equal bins numbered from 0; the outermost edges are included."""
    width = (high - low) / bins
    place = (value - F.lit(float(low))) / F.lit(float(width))
    number = F.greatest(F.ceil(place) - 1, F.lit(0)) if right_closed else F.least(F.floor(place), F.lit(bins - 1))
    measure = F.count(F.lit(1)).alias("n") if weight is None else F.sum("_weight").alias("weight")
    binned = df.select(
        *by, value.alias("_value"), number.cast("int").alias("bin"),
        (F.lit(1) if weight is None else weight).alias("_weight"))
    return binned.filter(F.col("_value").between(low, high)).groupBy(*by, "bin").agg(measure)


def density(df: DataFrame, column: str, points: int = 512) -> DataFrame:
    """Gaussian kernel density on a regular grid, rule-of-thumb bandwidth.

    Each value is shared linearly between its two neighbouring grid points in one
    aggregation, so the smoothing afterwards works on ``points`` rows whatever the data size. The
    bandwidth's spread is the smaller of standard deviation and scaled quartile distance; where that is 0, in
    turn the standard deviation, the smallest absolute value, and 1. No values give no rows.
    """
    summary = describe(df, [column]).select("n", "min", "max", "sd", "iqr").first()
    if summary is None or not summary["n"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    deviation = float(summary["sd"] or 0.0)
    spread = min(deviation, float(summary["iqr"] or 0.0) / 1.34) or deviation or abs(float(summary["min"])) or 1.0
    bandwidth = 0.9 * spread * summary["n"] ** -0.2
    low, high = summary["min"] - 3 * bandwidth, summary["max"] + 3 * bandwidth
    step = (high - low) / (points - 1)
    place = (F.col(column).cast("double") - F.lit(low)) / F.lit(step)
    left = F.floor(place)
    shares = F.array(
        F.struct(left.alias("cell"), (1 - (place - left)).alias("mass")),
        F.struct((left + 1).alias("cell"), (place - left).alias("mass")))
    masses = df.filter(F.col(column).isNotNull()).select(F.inline(shares)).groupBy("cell").agg(
        (F.sum("mass") / F.lit(float(summary["n"]))).alias("mass"))
    gap = (F.col("point") - F.col("cell")) * F.lit(step / bandwidth)
    kernel = F.exp(-0.5 * gap * gap) / F.lit(bandwidth * 2.5066282746310002)  # sqrt(2 pi)
    smoothed = masses.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return smoothed.groupBy("point").agg(F.sum(F.col("mass") * kernel).alias("density")).select(
        "point", (F.lit(low) + F.col("point") * F.lit(step)).alias("x"), "density")


def totals(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(name) for name, c in columns.items()])
