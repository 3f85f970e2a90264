"""Key, null and join checks, and the quarantine split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def quarantined(df: DataFrame, suspicious: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to report, rows to keep). A row whose predicate is null is kept."""
    flag = F.coalesce(suspicious, F.lit(False))
    return df.filter(flag), df.filter(~flag)


def join_cardinality(fact: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows before and after a left join to each dimension, and the rows without a match.

    Both sides are counted per key first, so a hot key is one row when the sides meet.
    """
    reports = []
    for name, (dimension, fact_key, dimension_key) in dimensions.items():
        left = fact.groupBy(F.col(fact_key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
        right = (
            dimension.filter(F.col(dimension_key).isNotNull())
            .groupBy(F.col(dimension_key).alias("_key")).agg(F.count(F.lit(1)).alias("_copies"))
        )
        zero = F.lit(0).cast("long")
        reports.append(
            left.join(right, "_key", "left").agg(
                F.coalesce(F.sum("_rows"), zero).alias("rows_before"),
                F.coalesce(F.sum(F.col("_rows") * F.coalesce("_copies", F.lit(1))), zero).alias("rows_after"),
                F.coalesce(F.sum(F.when(F.col("_copies").isNull(), F.col("_rows"))), zero).alias("rows_unmatched"),
            ).select(F.lit(name).alias("dimension"), "*")
        )
    return reduce(DataFrame.unionByName, reports)


def _common_type(left: DataFrame, right: DataFrame) -> DataType:
    """The type in which keys of both columns compare; text if one side is text and the other is not."""
    kinds = [df.schema[0].dataType for df in (left, right)]
    if kinds[0] != kinds[1] and StringType() in kinds:
        return StringType()
    return left.toDF("k").union(right.toDF("k")).schema["k"].dataType


def relationship_check(
    tables: Mapping[str, DataFrame], edges: Sequence[tuple[str, str, str, str, str]]
) -> DataFrame:
    """One row per declared edge ``(table1, column1, table2, column2, type)``.

    Reports the type seen in the data and the keys of each side that the other side lacks.
    An edge over a missing table or column is kept, with a note and no observations.
    """
    reports = []
    for table1, column1, table2, column2, declared in edges:
        head = [
            F.lit(v).alias(n)
            for n, v in zip(("table1", "column1", "table2", "column2", "declared_type"),
                            (table1, column1, table2, column2, declared))
        ]
        known = all(t in tables and c in tables[t].columns for t, c in ((table1, column1), (table2, column2)))
        if not known:
            spark = next(iter(tables.values())).sparkSession
            reports.append(spark.range(1).select(
                *head, F.lit(None).cast("string").alias("observed_type"),
                F.lit(None).cast("long").alias("unmatched_keys1"),
                F.lit(None).cast("long").alias("unmatched_keys2"),
                F.lit("column not found").alias("note"),
            ))
            continue
        side, kind = [], _common_type(tables[table1].select(column1), tables[table2].select(column2))
        for table, column, out in ((table1, column1, "_n1"), (table2, column2, "_n2")):
            side.append(
                tables[table].select(F.col(column).cast(kind).alias("_key")).filter("_key is not null")
                .groupBy("_key").agg(F.count(F.lit(1)).alias(out))
            )
        seen = side[0].join(side[1], "_key", "full").agg(
            F.max("_n1").alias("_max1"), F.max("_n2").alias("_max2"),
            F.count_if(F.col("_n2").isNull()).alias("unmatched_keys1"),
            F.count_if(F.col("_n1").isNull()).alias("unmatched_keys2"),
        )
        many1 = F.when(F.col("_max1") > 1, "N").otherwise("1")
        many2 = F.when(F.col("_max2") > 1, "N").otherwise("1")
        reports.append(seen.select(
            *head, F.concat(many1, F.lit(":"), many2).alias("observed_type"),
            "unmatched_keys1", "unmatched_keys2", F.lit(None).cast("string").alias("note"),
        ))
    return reduce(DataFrame.unionByName, reports)
