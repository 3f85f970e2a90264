"""Column profiles of tables and files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PROFILE_SCHEMA = (
    "table_name string, position int, column_name string, data_type string, max_length int, "
    "row_count bigint, filled_count bigint"
)


def column_profile(tables: Mapping[str, DataFrame], names: Sequence[str], spark: SparkSession) -> DataFrame:
    """Name, type, longest text, row and non-null counts of each column; one pass per table.

    Names that are not in ``tables`` contribute no rows.
    """
    profiles = []
    for name in names:
        if name not in tables:
            continue
        df = tables[name]
        measures = [F.count(F.lit(1)).alias("_rows")]
        for i, field in enumerate(df.schema.fields):
            measures.append(F.count(F.col(field.name)).alias(f"_filled_{i}"))
            longest = F.max(F.length(F.col(field.name))) if isinstance(field.dataType, T.StringType) else F.lit(None)
            measures.append(longest.cast("int").alias(f"_longest_{i}"))
        rows = F.array(*[
            F.struct(
                F.lit(name).alias("table_name"), F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"_longest_{i}").alias("max_length"), F.col("_rows").alias("row_count"),
                F.col(f"_filled_{i}").alias("filled_count"),
            )
            for i, field in enumerate(df.schema.fields)
        ])
        profiles.append(df.agg(*measures).select(F.inline(rows)))
    if not profiles:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    return reduce(DataFrame.unionByName, profiles)
