import datetime
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import classify, logistic, margins, topics
from tessera.operators.terms import TermClassifier
from tessera.session import fresh_path
from tessera.sources import profile, readers, writers
from tessera.streaming import daily


def test_delimiters_and_types(spark, tmp_path):
    for i, mark in enumerate([",", ";", "\t", "|"]):
        (tmp_path / f"f{i}.csv").write_text(f"a{mark}b{mark}c\n1{mark}x é{mark}2.5\n2{mark}{mark}3\n", encoding="utf-8")
        df = readers.read_delimited(spark, str(tmp_path / f"f{i}.csv"), mark)
        assert [t for _, t in df.dtypes] == ["int", "string", "double"]
        assert [tuple(r) for r in df.collect()] == [(1, "x é", 2.5), (2, None, 3.0)]
    with pytest.raises(ValueError):
        readers.read_delimited(spark, "x", "#")


def test_records(spark, tmp_path):
    schema = spark.createDataFrame([], "name string, quantity int").schema
    assert readers.read_records(spark, str(tmp_path / "none.json"), schema).count() == 0
    (tmp_path / "some.json").write_text('[{"name": "a", "quantity": 2}, {"name": "b"}]')
    rows = readers.read_records(spark, str(tmp_path / "some.json"), schema).collect()
    assert [tuple(r) for r in rows] == [("a", 2), ("b", None)]
    path = str(tmp_path / "out")
    writers.save_records(spark.createDataFrame(rows, schema), path)
    back = readers.read_records(spark, path, schema, array_file=False)
    assert back.count() == 2
    with pytest.raises(ValueError):
        writers.save_records(back, path)


def test_categories_and_profile(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    assert {r["k"]: r["level"] for r in readers.with_levels(df, "k", "level").filter("k is not null").collect()} == {"a": 0, "b": 1}
    assert readers.with_levels(df, "k", "level").filter("level is null").count() == 1
    rows = profile.column_profile({"t": df}, ["t", "missing"], spark).collect()
    assert [(r["column_name"], r["data_type"], r["max_length"], r["filled_count"]) for r in rows] == [("k", "string", 1, 3), ("v", "int", None, 3)]
    assert profile.column_profile({}, ["missing"], spark).count() == 0
    assert [tuple(r) for r in writers.stringified(df).collect()][2:] == [("None", "3"), ("b", "None")]


def test_tables(spark):
    path = fresh_path(spark, "t")
    name = "t_" + path.rsplit("-", 1)[-1]
    writers.replace_table(spark.createDataFrame([(1, "a")], "x int, y string"), name, path)
    writers.refill_table(spark.createDataFrame([("b", 2)], "y string, x int"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(2, "b")]
    writers.replace_table(spark.createDataFrame([(1.5,)], "z double"), name, path + "-2")
    assert spark.table(name).columns == ["z"]
    now = writers.stamped(spark.range(1)).first()["insert_timestamp"]
    assert abs((datetime.datetime.now() - now).total_seconds()) < 86_400


def corpus(spark):
    rows = []
    for i in range(120):
        spam = i % 3 == 0
        rows.append((i, (["win", "cash", f"w{i % 5}"] if spam else ["meeting", "agenda", f"m{i % 5}"]) + ["hello"], int(spam), int(i % 2)))
    return spark.createDataFrame(rows, "id long, tokens array<string>, toxic int, rude int")


def test_mail_classifier_separates_and_its_vectors_match_the_definition(spark):
    df = corpus(spark)
    model = TermClassifier.fit(df, "id", "tokens", "toxic")
    assert model.transform(df, "id", "tokens", ["toxic"]).filter(F.col("predicted") != F.col("toxic")).count() == 0
    table = {r["token"]: r for r in model.terms.table.collect()}
    assert "hello" not in table and sorted(table) == [t for t, _ in sorted(table.items(), key=lambda x: x[1]["term_id"])]
    odd = spark.createDataFrame([(1, ["w0", "w0", "m1", "new"]), (2, ["new"]), (3, []), (4, None)], "id long, tokens array<string>")
    rows = {r["id"]: r["features"] for r in model.terms.vectors(odd, "id", "tokens").collect()}
    raw = {t: n * (np.log(121 / (1 + table[t]["documents"])) + 1) for t, n in (("w0", 2), ("m1", 1))}
    assert {table[t]["term_id"]: pytest.approx(v / np.hypot(*raw.values())) for t, v in raw.items()} == dict(
        zip(rows[1].indices.tolist(), rows[1].values.tolist()))
    assert all(rows[i].size == len(table) and not len(rows[i].indices) for i in (2, 3, 4))


def test_mail_classifier_weights_are_those_of_an_independent_fit(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, [words[j] for j in rng.choice(12, 4)], int(rng.random() < 0.4)) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, toxic int")
    model = TermClassifier.fit(df, "id", "tokens", "toxic")
    x = np.array([r["features"].toArray() for r in model.terms.vectors(df, "id", "tokens").orderBy("id").collect()])
    x, y = np.c_[x, np.ones(len(x))], np.array([r[2] for r in rows])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    for _ in range(40):  # Newton steps on half the squared weights plus the log losses
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ beta)
    assert model.model.coefficients.toArray() == pytest.approx(beta[:-1], abs=1e-5)
    assert model.model.intercept == pytest.approx(beta[-1], abs=1e-5)
    assert model.slopes(df, "id", "tokens", "toxic").agg(F.max(F.abs("slope"))).first()[0] < 1e-7
    with pytest.raises(ValueError):
        TermClassifier.fit(df.limit(1), "id", "tokens", "toxic")


def test_mail_classifier_reaches_its_optimum_in_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1500):  # rare and common terms, toxic ones among them, some documents without a known term
        words = np.minimum(rng.zipf(1.15, 0 if i % 200 == 0 else 60), 5000)
        rows.append((i, [f"w{j}" for j in words], int(sum(words % 7 == 3) + rng.normal(0, 1) > 10)))
    df = spark.createDataFrame(rows, "id long, tokens array<string>, toxic int").repartition(5).persist()
    monkeypatch.setattr(logistic, "BLOCK", 1 << 12)
    model = TermClassifier.fit(df, "id", "tokens", "toxic")
    assert 0 < model.model.passes < 150
    slopes = model.slopes(df, "id", "tokens", "toxic")
    assert slopes.count() == model.terms.size > 500
    assert slopes.agg(F.max(F.abs("slope"))).first()[0] < 2e-9
    scored = {r["id"]: r["score"] for r in model.transform(df, "id", "tokens").collect()}
    assert len(scored) == 1500 and scored[0] == scored[200] == pytest.approx(1 / (1 + np.exp(-model.model.intercept)))
    alike = df.withColumn("toxic", F.lit(1))
    assert TermClassifier.fit(alike, "id", "tokens", "toxic").transform(alike, "id", "tokens").filter("score = 1").count() == 1500
    with pytest.raises(ValueError):
        TermClassifier.fit(df.withColumn("toxic", F.lit(None).cast("int")), "id", "tokens", "toxic")


def test_label_models_survive_saving(spark):
    df = corpus(spark)
    model = classify.fit_label_models(df, "tokens", {"toxic": 2.0, "rude": 1.0}, 1 << 8, 20)
    path = fresh_path(spark, "model")
    writers.save_model(model, path, {"toxic": 0.9, "rude": 0.1}, spark)
    loaded, thresholds = writers.load_model(path, spark)
    assert thresholds == {"toxic": 0.9, "rude": 0.1}
    a = classify.label_flags(model, df, ["toxic", "rude"], thresholds)
    b = classify.label_flags(loaded, df, ["toxic", "rude"], thresholds)
    assert a.exceptAll(b).isEmpty()
    assert classify.label_flags(model, df, ["toxic", "rude"]).filter("toxic_flag <> toxic").count() == 0


def test_squared_hinge_is_at_its_optimum(spark):
    rng = np.random.default_rng(3)
    for n, size, cost in ((300, 5, 1.0), (60, 80, 0.3), (200, 3, 50.0)):
        x = rng.normal(size=(n, size)) * rng.choice([1, 10], size)
        y = (x[:, 0] + rng.normal(size=n) > 0.3).astype(int)
        df = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)] + [(None, 1), (x[0].tolist(), None)], "v array<double>, y int")
        model = margins.fit(df.repartition(10 if n == 60 else 2), "v", "y", cost)
        ones, sign, w = np.c_[x, np.ones(n)], 2 * y - 1, np.append(model.coefficients, model.intercept)

        def slope(w):
            return w - 2 * cost * ones.T @ (sign * np.maximum(1 - sign * (ones @ w), 0))

        assert np.abs(slope(w)).max() < 1e-6 * np.abs(slope(np.zeros_like(w))).max()
        applied = model.apply(df.filter("v is not null and y is not null"), "v").collect()
        assert [r["predicted"] for r in applied] == [int(np.dot(r["v"], w[:-1]) + w[-1] > 0) for r in applied]
    for bad in ([], [([1.0], 1), ([1.0, 2.0], 0)]):
        with pytest.raises(ValueError):
            margins.fit(spark.createDataFrame(bad, "v array<double>, y int"), "v", "y")


def test_topics(spark):
    counter, model = topics.fit_topics(corpus(spark), "tokens", 2, passes=5, max_share=0.9)
    terms = topics.leading_terms(counter, model, 3)
    assert terms.groupBy("topic").count().select("count").distinct().first()[0] == 3
    vectors = topics.topic_vectors(model)
    a, b = [dict((r["term"], r["weight"]) for r in vectors.filter(F.col("vector") == k).collect()) for k in (0, 1)]
    x, y = np.array([a[t] for t in sorted(a)]), np.array([b[t] for t in sorted(a)])
    wanted = 1 - x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    assert topics.mean_distance(vectors).first()[0] == pytest.approx(wanted)


def test_windowed_totals_leave_open_days_pending(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(start + datetime.timedelta(hours=6 * i), float(i)) for i in range(40)]
    spark.createDataFrame(rows, "ts timestamp, v double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, v double").parquet(str(tmp_path / "in"))
    out = daily.windowed_totals(stream, "ts", F.col("v"))
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    closed = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    assert 7 <= closed.count() < 10
    assert closed.orderBy("window").first()["total_amount"] == 0 + 1 + 2 + 3


def test_record_arrays_and_bitmaps(spark, tmp_path):
    records = spark.range(25).selectExpr("id", "if(id % 3 = 0, null, concat('n,\"', id)) as name")
    path = str(tmp_path / "arrays")
    writers.save_record_arrays(records, path, 4)
    back = readers.read_records(spark, path, records.schema).select("id", "name")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, records.collect()))
    assert 4 <= len(list((tmp_path / "arrays").glob("part=*/*.txt"))) <= 7
    writers.save_record_arrays(records.limit(0), str(tmp_path / "none"))

    rng = np.random.default_rng(1)
    rows = [(f"a b/{k}", h, w, bytearray(rng.integers(0, 256, h * w).astype(np.uint8).tobytes())) for k, (h, w) in enumerate([(3, 5), (1, 1), (40, 64)])]
    folder = str(tmp_path / "images")
    images = spark.createDataFrame(rows, "image string, height int, width int, pixels binary")
    assert writers.save_bitmaps(images, folder) == 3
    found = {(r["height"], r["width"]): bytes(r["pixels"]) for r in readers.read_images(spark, folder).collect()}
    assert found == {(h, w): bytes(p) for _, h, w, p in rows}


def test_many_small_images_share_tasks(spark, tmp_path):
    images = spark.createDataFrame([(str(k), 2, 2, bytearray(4)) for k in range(700)], "image string, height int, width int, pixels binary")
    writers.save_bitmaps(images, str(tmp_path / "images"))
    found = readers.read_images(spark, str(tmp_path / "images"))
    assert found.count() == 700 and found.rdd.getNumPartitions() <= 16


def test_folders_of_many_images_are_listed_in_groups(spark, tmp_path, monkeypatch):
    images = spark.createDataFrame([(str(k), 1 + k % 3, 2, bytearray([k % 256, 7] * (1 + k % 3))) for k in range(300)],
                                   "image string, height int, width int, pixels binary")
    folder = str(tmp_path / "images")
    assert writers.save_bitmaps(images, folder) == 300
    (tmp_path / "images" / "_hidden").mkdir()
    at_once = sorted(map(tuple, readers.read_images(spark, folder).collect()))
    monkeypatch.setattr(readers, "FOLDER_FILES", 100)
    groups = readers._groups(spark, folder)
    assert len(groups) >= 4 and sum(length for _, length in groups) == sum(f.stat().st_size for f in (tmp_path / "images").rglob("*.bmp"))
    assert max(sum(1 for p in paths for _ in Path(p.removeprefix("file:")).glob("*")) for paths, _ in groups) <= 200  # with check sums
    assert sorted(map(tuple, readers.read_images(spark, folder).collect())) == at_once and len(at_once) == 300
    assert readers.read_images(spark, folder, 2, 2).count() == 100


def test_a_summed_hessian_needs_few_passes_and_finds_the_same_optimum(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 40)) * np.logspace(0, 3, 40)  # hard for steps that know only products of the Hessian
    y = (x[:, 0] + x[:, 39] / 1000 + rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "v array<double>, y int").repartition(2)
    formed = margins.fit(df, "v", "y")
    assert formed.passes <= 40
    monkeypatch.setattr(margins, "FORMED", 0)
    products = margins.fit(df, "v", "y", max_iterations=3)
    assert products.passes > formed.passes
    ones, sign, w = np.c_[x, np.ones(400)], 2 * y - 1, np.append(formed.coefficients, formed.intercept)
    slope = lambda w: w - 2 * ones.T @ (sign * np.maximum(1 - sign * (ones @ w), 0))
    assert np.abs(slope(w)).max() < 1e-6 * np.abs(slope(np.zeros_like(w))).max()
