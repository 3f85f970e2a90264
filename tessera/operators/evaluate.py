"""Scores to decisions, confusion counts, reports, threshold search and losses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.scalar import safe_ratio
from tessera.operators.ordered import running

# 18 thresholds from 0.05 to 0.90.
THRESHOLDS = tuple(float(t) for t in np.linspace(0.05, 0.90, 18))


def decided(score: Column, threshold: float | Column = 0.5, strict: bool = False) -> Column:
    """1 when the score reaches the threshold; ``strict`` asks for more than the threshold."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score > limit if strict else score >= limit).cast("int")


def long_scores(df: DataFrame, row_id: str, labels: Mapping[str, str]) -> DataFrame:
    """(id, label, y, p) from one truth and one score column per label."""
    entries = [
        F.struct(F.lit(name).alias("label"), F.col(name).cast("int").alias("y"), F.col(score).cast("double").alias("p"))
        for name, score in labels.items()
    ]
    return df.select(row_id, F.inline(F.array(*entries)))


def confusion(df: DataFrame, truth: str = "y", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def _ratios(tp: Column, fp: Column, fn: Column) -> list[Column]:
    zero = F.lit(0.0)
    return [
        F.coalesce(safe_ratio(tp.cast("double"), tp + fp), zero).alias("precision"),
        F.coalesce(safe_ratio(tp.cast("double"), tp + fn), zero).alias("recall"),
        F.coalesce(safe_ratio(2 * tp.cast("double"), 2 * tp + fp + fn), zero).alias("f1"),
    ]


def _report(counts: DataFrame) -> DataFrame:
    """Rows per class, then macro, micro and weighted averages. ``counts``: class, tp, fp, fn."""
    per_class = counts.select(
        "class", *_ratios(F.col("tp"), F.col("fp"), F.col("fn")), (F.col("tp") + F.col("fn")).alias("support"),
        "tp", "fp", "fn")
    measures = ["precision", "recall", "f1"]
    support = F.sum("support").alias("support")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], support).withColumn("class", F.lit("macro avg"))
    weighted = per_class.agg(*[
        F.coalesce(safe_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")), F.lit(0.0)).alias(m) for m in measures
    ], support).withColumn("class", F.lit("weighted avg"))
    sums = per_class.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    micro = sums.select(F.lit("micro avg").alias("class"), *_ratios(F.col("tp"), F.col("fp"), F.col("fn")),
                        (F.col("tp") + F.col("fn")).alias("support"))
    out = per_class.drop("tp", "fp", "fn")
    return out.unionByName(macro).unionByName(micro).unionByName(weighted)


def class_report(df: DataFrame, truth: str = "y", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support of every class of a single-label task."""
    cells = confusion(df, truth, predicted)
    hit = F.col(truth) == F.col(predicted)
    n, zero = F.col("n"), F.lit(0).cast("long")
    shares = F.array(
        F.struct(F.col(truth).cast("string").alias("class"), F.when(hit, n).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(hit, zero).otherwise(n).alias("fn")),
        F.struct(F.col(predicted).cast("string").alias("class"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(n).alias("fp"), zero.alias("fn")))
    counts = cells.select(F.inline(shares)).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return _report(counts)


def label_report(scores: DataFrame) -> DataFrame:
    """Report of a multi-label task from (label, y, predicted) rows: one class per label."""
    y, hat = F.col("y") == 1, F.col("predicted") == 1
    counts = scores.groupBy(F.col("label").alias("class")).agg(
        F.count_if(y & hat).alias("tp"), F.count_if(~y & hat).alias("fp"), F.count_if(y & ~hat).alias("fn"))
    return _report(counts)


def accuracy(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Share of rows where every truth column equals its prediction (exact match)."""
    same = F.lit(True)
    for truth, predicted in pairs.items():
        same = same & (F.col(truth) == F.col(predicted))
    return df.agg(F.avg(same.cast("double")).alias("accuracy"))


def threshold_scores(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """F1 of every label at every threshold, from (label, y, p) rows.

    Rows are counted by the number of thresholds they reach, so each row is read once and
    the thresholds are then combined from at most ``len(thresholds) + 1`` counts per label.
    """
    limits = sorted(float(t) for t in thresholds)
    reached = sum(((F.col("p") >= F.lit(t)).cast("int") for t in limits), F.lit(0))
    counts = scores.groupBy("label", reached.alias("_reached")).agg(
        F.count_if(F.col("y") == 1).alias("_pos"), F.count(F.lit(1)).alias("_all"))
    positives = F.sum("_pos").alias("positives")
    measures = []
    for i, t in enumerate(limits):
        inside = F.col("_reached") > i
        measures.append(F.struct(
            F.lit(t).alias("threshold"),
            F.coalesce(F.sum(F.when(inside, F.col("_pos"))), F.lit(0)).alias("tp"),
            F.coalesce(F.sum(F.when(inside, F.col("_all"))), F.lit(0)).alias("predicted")))
    wide = counts.groupBy("label").agg(positives, F.array(*measures).alias("_m"))
    rows = wide.select("label", "positives", F.inline("_m"))
    f1 = F.coalesce(safe_ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("positives")), F.lit(0.0))
    return rows.select("label", "threshold", f1.alias("f1"))


def best_thresholds(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """The threshold with the highest F1 per label; the lowest one on ties."""
    best = F.max(F.struct("f1", -F.col("threshold"))).alias("_b")
    return threshold_scores(scores, thresholds).groupBy("label").agg(best).select(
        "label", (-F.col("_b.col2")).alias("threshold"), F.col("_b.f1").alias("f1"))


def precision_recall_area(scores: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    """Area under the precision-recall curve by trapezoids.

    Equal scores are one point; the first point is continued to recall 0.
    """
    by = list(by)
    counts = scores.groupBy(*by, "p").agg(
        F.count_if(F.col("y") == 1).alias("_pos"), F.count(F.lit(1)).alias("_all"))
    curve = running(counts, [F.desc("p")], by, sums={"_tp": "_pos", "_seen": "_all"})
    before_tp, before_seen = F.col("_tp") - F.col("_pos"), F.col("_seen") - F.col("_all")
    precision = F.col("_tp") / F.col("_seen")
    earlier = F.when(before_seen == 0, precision).otherwise(F.try_divide(before_tp, before_seen))
    strip = F.col("_pos") * (precision + earlier) / 2
    return curve.groupBy(*by).agg(safe_ratio(F.sum(strip), F.sum("_pos")).alias("area"))


def focal_loss(truth: Column, score: Column, weight: Column, gamma: float = 2.0, epsilon: float = 1e-7) -> Column:
    """Weighted cross-entropy that fades out for easy rows."""
    p = F.least(F.greatest(score, F.lit(epsilon)), F.lit(1 - epsilon))
    y = truth.cast("double")
    entropy = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    hit = y * score + (1 - y) * (1 - score)
    return weight * F.pow(1 - hit, F.lit(float(gamma))) * entropy
