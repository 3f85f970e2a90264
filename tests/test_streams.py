import datetime

import pytest
from pyspark.sql import functions as F

from tessera.operators import classify
from tessera.streaming import runs
from tessera.streaming.daily import DailyTotals

SCHEMA = "id long, ts timestamp_ntz, amount long"


def at(day, hour=0):
    return datetime.datetime(2024, 3, 1) + datetime.timedelta(days=day, hours=hour)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def totals(frame):
    return {r["date"].day: r["total_amount"] for r in frame.collect()}


def test_late_on_time_and_repeated_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    batches = [
        [(1, at(0, 1), 10), (2, at(0, 2), 20), (3, at(1), 5)],
        [(4, at(4), 7), (5, at(0, 5), 1), (2, at(0, 2), 20)],  # 5 is late, 2 comes again
        [(6, at(5), 3), (3, at(1), 5), (7, at(2), 9), (7, at(2), 9)],  # 3 comes again, 7 twice in one batch
    ]
    for rows in batches:
        arrive(spark, folder, rows)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    daily = DailyTotals(spark, str(tmp_path / "state"), "6 days")
    wanted = {1: 31, 2: 5, 5: 7, 6: 3, 3: 9}
    assert totals(daily.run(source, "ts", F.col("amount"), "id")) == wanted
    assert {(r["batch"], r["date"].day) for r in daily.changes().collect()} == {(0, 1), (0, 2), (1, 5), (1, 1), (2, 6), (2, 3)}
    assert totals(daily.run(source, "ts", F.col("amount"), "id")) == wanted  # nothing new

    arrive(spark, folder, [(8, at(40), 100)])
    daily.run(source, "ts", F.col("amount"), "id")
    arrive(spark, folder, [(9, at(41), 1)])
    daily.run(source, "ts", F.col("amount"), "id")
    arrive(spark, folder, [(10, at(0, 3), 1000), (11, at(39), 2)])  # 10 is behind the watermark, 11 is not
    found = daily.run(source, "ts", F.col("amount"), "id").collect()
    assert {(r["date"].month, r["date"].day): r["total_amount"] for r in found} == {
        **{(3, d): t for d, t in wanted.items()}, (4, 10): 100, (4, 11): 1, (4, 9): 2}


def test_a_repeated_batch_overwrites_its_days(spark, tmp_path):
    """After a failure between writing and committing, the same batch is run again from the checkpoint."""
    folder, daily = str(tmp_path / "in"), DailyTotals(spark, str(tmp_path / "state"))
    arrive(spark, folder, [(1, at(0), 1), (2, at(1), 2)])
    source = spark.readStream.schema(SCHEMA).parquet(folder)
    daily.run(source, "ts", F.col("amount"))
    (tmp_path / "state/checkpoint/commits/0").unlink()
    (tmp_path / "state/checkpoint/commits/.0.crc").unlink(missing_ok=True)
    arrive(spark, folder, [(3, at(1), 4)])
    assert totals(daily.run(source, "ts", F.col("amount"))) == {1: 1, 2: 6}


def test_batches_of_an_ordered_stream_are_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(runs, "ROWS_PER_FILE", 50)
    stream = runs.ordered_stream(spark.range(1000), "id", batches=2)
    seen = []
    runs.drain(stream, lambda batch, _: seen.append(batch.withColumn("file", F.input_file_name()).agg(
        F.count_distinct("file"), F.min("id"), F.max("id")).first()))
    assert [files for files, *_ in seen] == [8, 8]
    assert seen[0][1] == 0 and seen[0][2] + 1 == seen[1][1] and seen[1][2] == 999


def test_files_of_a_batch_stay_small_and_come_together(spark):
    stream = runs.ordered_stream(spark.range(1000), "id", batches=2, largest=10)
    seen = []
    runs.drain(stream, lambda batch, _: seen.append(batch.withColumn("file", F.input_file_name()).groupBy("file").agg(
        F.count("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).agg(F.sum("n"), F.max("n"), F.min("low"), F.max("high")).first()))
    assert len(seen) == 2 and sum(n for n, *_ in seen) == 1000
    assert all(most <= 30 for _, most, *_ in seen)  # dealt out by row, not quite evenly; 62 with a file a core
    assert seen[0][2] == 0 and seen[0][3] + 1 == seen[1][2] and seen[1][3] == 999


def test_label_models_cache_no_vectors(spark, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("vectors are cached"))
    rows = [(i, ["good", "words", f"w{i % 5}"] if i % 2 else ["bad", "words", f"w{i % 3}"], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, words array<string>, toxic int")
    model = classify.fit_label_models(df, "words", {"toxic": 2.0}, 1 << 8, 20)
    assert classify.label_flags(model, df, ["toxic"]).filter("toxic_flag <> toxic").isEmpty()
