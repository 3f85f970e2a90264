"""Awkward inputs whose result is easy to get wrong."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import boxes, describe, quality, topics


@pytest.mark.parametrize("raw,clean", [
    ("see www.x.it now", "see wwwxit now"), ("see https://x.it/a?b now", "see now"), ("HTTP://x.it", ""), ("a\tb", "a\tb"),
    ("a\n\nb", "a b"), ("  a   b  ", "a b"), ("a\u00a0b", "a\u00a0b"), ("\u2003a\u2003", "a"), ("caf\u00e9 1!", "caf"), ("", ""), (None, None),
])
def test_cleaned_comment(spark, raw, clean):
    row = spark.createDataFrame([(raw,)], "t string").select(text.cleaned_comment(F.col("t")).alias("c")).first()
    assert row["c"] == clean


def test_words_are_cut_at_any_white_space(spark):
    row = spark.createDataFrame([("a\tb  c\u00a0d ",)], "t string").select(text.words(F.col("t")).alias("w")).first()
    assert row["w"] == ["a", "b", "c", "d"]


def test_vectors_without_a_common_term_are_a_pair(spark):
    vectors = spark.createDataFrame([(0, "x", 1.0), (1, "x", 2.0), (2, "y", 1.0)], "vector int, term string, weight double")
    found = {(r["first"], r["second"]): r["distance"] for r in topics.cosine_distances(vectors).collect()}
    assert found == {(0, 1): pytest.approx(0), (0, 2): 1.0, (1, 2): 1.0}
    assert topics.mean_distance(vectors).first()[0] == pytest.approx(2 / 3)


@pytest.mark.parametrize("values", [[3.0] * 5, [-2.0] * 3, [0.0] * 4, [7.0], [1.0, 1.0, 1.0, 1.0, 9.0]])
def test_density_of_hardly_varying_values(spark, values):
    rows = describe.density(spark.createDataFrame([(v,) for v in values], "v double"), "v", 128).orderBy("point").collect()
    step = rows[1]["x"] - rows[0]["x"]
    assert sum(r["density"] for r in rows) * step == pytest.approx(1, abs=0.02)
    assert all(math.isfinite(r["density"]) for r in rows)


def test_density_of_nothing(spark):
    assert describe.density(spark.createDataFrame([], "v double"), "v").count() == 0


def test_keys_of_different_number_types_match(spark):
    tables = {"a": spark.createDataFrame([(1.0,), (2.0,)], "k double"), "b": spark.createDataFrame([(1,), (2,)], "k long"),
              "c": spark.createDataFrame([("1",), ("x",)], "k string")}
    rows = quality.relationship_check(tables, [("a", "k", "b", "k", "1:1"), ("b", "k", "c", "k", "1:1")]).collect()
    assert (rows[0]["unmatched_keys1"], rows[0]["unmatched_keys2"]) == (0, 0)
    assert (rows[1]["unmatched_keys1"], rows[1]["unmatched_keys2"]) == (1, 1)


def test_boxes_of_the_null_image_suppress_each_other(spark):
    rows = [(None, "a", 0, 0, 10, 10), (None, "b", 0, 0, 10, 10), (1, "a", 0, 0, 10, 10), (1, "b", 50, 50, 10, 10)]
    df = spark.createDataFrame(rows, "image long, box string, x int, y int, w int, h int").withColumn("score", F.lit(1.0))
    kept = boxes.suppress(df.select(*boxes.BOX))
    assert sorted(((r["image"] or 0, r["box"]) for r in kept.collect())) in ([(0, "a"), (1, "a"), (1, "b")], [(0, "b"), (1, "a"), (1, "b")])
