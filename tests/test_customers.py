import datetime

from pyspark.sql import functions as F

from tessera.functions.scalar import (
    completed_years, label_number, parsed_date, period_key, right_closed_class, safe_ratio)
from tessera.operators import features, quality

D = datetime.date


def test_age_counts_leap_birthday_from_first_of_march(spark):
    df = spark.createDataFrame([(D(2000, 2, 29), D(2025, 2, 28)), (D(2000, 2, 29), D(2025, 3, 1)), (D(2000, 1, 1), D(2026, 1, 1)),
                                (None, D(2026, 1, 1))], "b date, a date")
    assert [r[0] for r in df.select(completed_years(F.col("b"), F.col("a"))).collect()] == [24, 25, 26, None]


def test_scalar_edges(spark):
    df = spark.createDataFrame([("2024-02-29 10:00:00", 10.0, 0.0), ("nonsense", 20.0, 2.0), (None, 110.0, 5.0), ("x", 20.1, 1.0)],
                               "t string, v double, d double")
    out = df.select(parsed_date(F.col("t")).alias("day"), right_closed_class(F.col("v"), 10, 110, 10).alias("c"),
                    safe_ratio(F.col("v"), F.col("d")).alias("r"), period_key(F.lit(2024), F.lit(3)).alias("p"),
                    label_number(F.col("t"), {"x": 1}).alias("n")).collect()
    assert [r["day"] for r in out] == [D(2024, 2, 29), None, None, None]
    assert [r["c"] for r in out] == [None, 1, 10, 2]  # a value on a limit belongs to the class below
    assert out[0]["r"] is None and out[1]["r"] == 10.0
    assert out[0]["p"] == "202403" and [r["n"] for r in out] == [None, None, None, 1]


def test_feature_table_keeps_every_customer(spark):
    customers = spark.createDataFrame([(1, D(1990, 5, 5)), (2, None), (3, D(2000, 2, 29))], "c long, birth date")
    accounts = spark.createDataFrame([(10, 1, 0), (11, 1, 9), (12, 2, 1), (13, None, 0)], "a long, owner long, kind int")
    moves = spark.createDataFrame([(10, "+", 5.0), (10, "-", 2.0), (11, "+", 1.5), (13, "+", 99.0), (None, "+", 7.0), (77, "+", 1.0)],
                                  "acc long, sign string, amount double")
    out = {r["c"]: r for r in features.customer_features(
        customers, accounts, moves, customer_key="c", account_owner="owner", account_key="a", movement_account="acc",
        account_type="kind", types={0: "base", 1: "business"}, sign="sign", signs={"+": "in", "-": "out"}, amount="amount",
        birth_date="birth", as_of=F.lit("2025-02-28").cast("date")).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1]["age"] == 34 and out[2]["age"] is None and out[3]["age"] == 24
    assert out[1]["accounts_total"] == 2 and out[1]["accounts_base"] == 1
    assert out[1]["in_amount"] == 6.5 and out[1]["in_amount_base"] == 5.0  # an unknown type counts in the total only
    assert out[2]["accounts_total"] == 1 and out[2]["in_count"] == 0
    assert out[3]["accounts_total"] == 0 and out[3]["out_amount"] == 0.0


def test_quality_checks(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k long")
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    r = quality.join_cardinality(fact, {"d": (dim, "k", "id")}).first()
    assert (r["rows_before"], r["rows_after"], r["rows_unmatched"]) == (5, 6, 2)
    assert fact.join(dim, fact["k"] == dim["id"], "left").count() == 6
    assert quality.join_cardinality(fact.limit(0), {"d": (dim, "k", "id")}).first()["rows_before"] == 0
    assert [tuple(r) for r in quality.duplicate_keys(fact, ["k"]).collect()] == [(1, 2)]
    assert quality.null_keys(fact, ["k"]).count() == 1
    bad, kept = quality.quarantined(fact, F.col("k") < 2)
    assert bad.count() == 2 and kept.count() == 3  # a null predicate is kept


def test_relationship_types(spark):
    one = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    many = spark.createDataFrame([(1,), (1,), (4,)], "k int")
    edges = [("one", "k", "many", "k", "1:1"), ("many", "k", "one", "nope", "N:1")]
    rows = quality.relationship_check({"one": one, "many": many}, edges).collect()
    assert rows[0]["observed_type"] == "1:N" and rows[0]["unmatched_keys1"] == 2 and rows[0]["unmatched_keys2"] == 1
    assert rows[1]["note"] == "column not found"
