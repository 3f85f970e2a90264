"""Registered queries and, where the result can be stated in SQL, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, so that the last bits of a sum do not decide a comparison."""
    return df.select(*[
        F.round(F.col(name), digits).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
    ])
