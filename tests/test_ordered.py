import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.ordered import lagged, running
from tessera.operators.quantiles import QUARTILES, Ranked, percentiles


def rows_with_hot_group(n=3000):
    rng = random.Random(1)
    return [(i, "hot" if i % 3 else f"g{i % 7}", rng.randrange(50)) for i in range(n)]


def test_running_matches_plain_loop(spark):
    data = rows_with_hot_group()
    df = spark.createDataFrame(data, "id long, g string, v long")
    got = {r["id"]: (r["rank"], r["total"]) for r in running(df, [F.desc("v"), "id"], ["g"], {"total": "v"}, "rank").collect()}
    seen = {}
    for i, g, v in sorted(data, key=lambda r: (r[1], -r[2], r[0])):
        rank, total = seen.get(g, (0, 0))
        seen[g] = rank + 1, total + v
        assert got[i] == seen[g]


def test_running_keeps_null_group_and_null_values(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a", None if i % 5 == 0 else i) for i in range(200)], "id long, g string, v long")
    out = running(df, ["id"], ["g"], {"total": "v"}, "rank").collect()
    for group in (None, "a"):
        total = 0
        for rank, r in enumerate(sorted((r for r in out if r["g"] == group), key=lambda r: r["id"]), 1):
            total += r["v"] or 0
            assert r["rank"] == rank
            assert (r["total"] or 0) == total


def test_lag_crosses_blocks_and_slices(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 10)
    out = {r["id"]: (r["one"], r["seven"]) for r in lagged(df, ["id"], {"one": ("v", 1), "seven": ("v", 7)}, block=16).collect()}
    assert len(out) == 1000
    for i in range(1000):
        assert out[i] == ((i - 1) * 10 if i >= 1 else None, (i - 7) * 10 if i >= 7 else None)


def spread_groups():
    rng = np.random.default_rng(3)
    return ([("hot", float(x)) for x in rng.normal(size=4000)] + [("one", 5.0)] + [("flat", 2.0)] * 50 + [("none", None)]
            + [("few", float(x)) for x in rng.integers(0, 4, 3000)] + [(None, float(x)) for x in rng.exponential(size=2500)]
            + [("heavy", float(x)) for x in rng.standard_cauchy(size=3000)] + [("ends", x) for x in [0.0, -0.0, 1e300, -1e300] * 300])


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_percentiles_are_exact(spark, accuracy):
    data = spread_groups()
    df = spark.createDataFrame(data, "g string, v double")
    wanted = {"a": 0.25, "b": 0.99, "c": 0.0, "d": 1.0, "e": 0.251}
    out = {r["g"]: r for r in percentiles(df, ["v"], wanted, ["g"], accuracy=accuracy).collect()}
    for g in {g for g, v in data if v is not None}:
        values = [v for h, v in data if h == g]
        for name, p in wanted.items():
            assert out[g][name] == pytest.approx(np.percentile(values, 100 * p), rel=1e-12, abs=1e-12)
    assert "none" not in out


@pytest.mark.parametrize("accuracy", [60, 10_000])
def test_box_statistics_from_the_same_two_reads(spark, accuracy):
    data = spread_groups()
    ranked = Ranked(spark.createDataFrame(data, "g string, v double"), ["v"], QUARTILES, ["g"], accuracy, fence=1.5)
    found = {r["g"]: r for r in ranked.named(ranked.boxes(), *QUARTILES, "n", "low_whisker", "high_whisker", "outliers").collect()}
    for g in {g for g, v in data if v is not None}:
        values = np.array([v for h, v in data if h == g])
        q1, q3 = np.percentile(values, 25), np.percentile(values, 75)
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        row = found[g]
        assert (row["n"], row["outliers"]) == (len(values), len(values) - len(inside))
        assert (row["low_whisker"], row["high_whisker"]) == (inside.min(), inside.max())
    assert "none" not in found


def test_two_reads_of_the_table_are_enough(spark, tmp_path):
    """The plans of the two reads scan the table once each; nothing after them does."""
    path = str(tmp_path / "fact")
    spark.range(5000).selectExpr("id % 3 as g", "cast(id * 7 % 1000 as double) as v", "sqrt(id) as w").write.parquet(path)
    fact = spark.read.parquet(path)
    ranked = Ranked(fact, ["v", "w"], QUARTILES, ["g"], 100, fence=1.5)
    for frame in (ranked.percentiles(), ranked.boxes(), ranked.moments()):
        assert path not in frame._jdf.queryExecution().toString()
    rows = ranked.entries.count()
    assert rows < 3000  # of 10,000 values: those inside enclosures, and gaps


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(rows_with_hot_group(500), "id long, g string, v long")
    first = running(df.repartition(1), ["v", "id"], ["g"], {"t": "v"}, "r")
    second = running(df.repartition(7), ["v", "id"], ["g"], {"t": "v"}, "r")
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_percentiles_of_every_small_size(spark):
    data = [(n, float(i * i)) for n in range(1, 40) for i in range(n)]
    df = spark.createDataFrame(data, "n long, v double")
    wanted = {"a": 0.05, "b": 0.25, "c": 0.5, "d": 0.99}
    for accuracy in (20, 10_000):  # the coarse sketch makes the larger groups take both passes
        for r in percentiles(df, ["v"], wanted, ["n"], accuracy=accuracy).collect():
            values = [v for n, v in data if n == r["n"]]
            for name, p in wanted.items():
                assert abs(r[name] - np.percentile(values, 100 * p)) < 1e-9
