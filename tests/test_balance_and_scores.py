import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import balance, evaluate


def labelled(spark, n=1000):
    return spark.range(n).select("id", (F.col("id") % 50 == 0).cast("int").alias("a"), (F.col("id") % 7 == 0).cast("int").alias("b"))


def test_split_is_an_exact_partition(spark):
    df = labelled(spark, 997)
    train, test = balance.random_split(df, "id", 0.2)
    assert test.count() == 200 and train.count() == 797
    assert train.join(test, "id").isEmpty()
    parts = balance.three_way_split(df, "id")
    assert [p.count() for p in parts] == [697, 150, 150]
    again = balance.random_split(df.repartition(5), "id", 0.2)[1]
    assert again.exceptAll(test).isEmpty()


def test_stratified_split_keeps_shares(spark):
    train, test = balance.stratified_split(labelled(spark), "id", "a", 0.25)
    counts = {r["a"]: r["count"] for r in test.groupBy("a").count().collect()}
    assert counts == {0: 245, 1: 5}
    assert train.count() == 750


def test_undersampling_and_oversampling(spark):
    df = labelled(spark)
    negatives = df.filter("a + b = 0").count()
    kept = balance.undersample_negatives(df, "id", ["a", "b"], 0.16)
    assert kept.filter("a + b = 0").count() == int(negatives * 0.16)
    assert kept.filter("a + b > 0").count() == 1000 - negatives
    assert balance.undersample_negatives(df, "id", ["a", "b"], 0.0).count() == 1000 - negatives
    more = balance.oversample(df, {"a": 3, "b": 2}).groupBy("id", "a", "b").count().collect()
    assert all(r["count"] == max(3 * r["a"], 2 * r["b"], 1) for r in more)
    assert balance.sample_rows(df, "id", 17).count() == 17


def scores(spark, n=400):
    rng = np.random.default_rng(0)
    y = rng.random(n) < 0.3
    p = np.round(np.clip(0.3 * y + 0.6 * rng.random(n), 0, 1), 2)
    return spark.createDataFrame([("l", int(a), float(b)) for a, b in zip(y, p)], "label string, y int, p double"), y, p


def test_threshold_search_matches_a_plain_loop(spark):
    df, y, p = scores(spark)

    def f1(t):
        hat = p >= t
        return 2 * (hat & y).sum() / max(hat.sum() + y.sum(), 1)

    wanted = [f1(t) for t in evaluate.THRESHOLDS]
    got = {r["threshold"]: r["f1"] for r in evaluate.threshold_scores(df).collect()}
    assert np.allclose([got[t] for t in evaluate.THRESHOLDS], wanted)
    best = evaluate.best_thresholds(df).first()
    assert best["threshold"] == evaluate.THRESHOLDS[int(np.argmax(wanted))]


def test_area_matches_the_library(spark):
    df, _, _ = scores(spark)
    wanted = BinaryClassificationEvaluator(rawPredictionCol="v", labelCol="y", metricName="areaUnderPR", numBins=0).evaluate(
        df.select(array_to_vector(F.array(1 - F.col("p"), "p")).alias("v"), F.col("y").cast("double").alias("y")))
    assert abs(evaluate.precision_recall_area(df).first()["area"] - wanted) < 1e-9


def test_reports_with_empty_denominators(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 0, 0), ("b", 1, 0), ("b", 1, 1)], "label string, y int, predicted int")
    out = {r["class"]: r for r in evaluate.label_report(df).collect()}
    assert (out["a"]["precision"], out["a"]["recall"], out["a"]["f1"]) == (0, 0, 0)
    assert out["b"]["precision"] == 1 and out["b"]["recall"] == 0.5
    assert out["macro avg"]["f1"] == pytest.approx(1 / 3) and out["micro avg"]["f1"] == pytest.approx(2 / 3)
    assert out["weighted avg"]["recall"] == 0.5 and out["b"]["support"] == 2
    single = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert single["0"]["recall"] == 1 and single["1"]["support"] == 2


def test_decisions_at_the_threshold(spark):
    df = spark.createDataFrame([(0.5,), (0.51,)], "p double")
    assert [tuple(r) for r in df.select(evaluate.decided(F.col("p")), evaluate.decided(F.col("p"), strict=True)).collect()] == [(1, 0), (1, 1)]


def test_focal_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.8), (1, 1.0), (0, 1.0)], "y int, p double")
    out = [r[0] for r in df.select(evaluate.focal_loss(F.col("y"), F.col("p"), F.lit(2.0))).collect()]
    assert out[0] == pytest.approx(2 * 0.2**2 * -np.log(0.8))
    assert out[1] == pytest.approx(2 * 0.8**2 * -np.log(0.2))
    assert out[2] == 0 and np.isfinite(out[3])
