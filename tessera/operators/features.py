"""Customer feature table: signed totals, account counts and the sign-by-type pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.scalar import completed_years, money, zero_if_null


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left equi-joins of a fact to dimensions with differently named keys.

    No broadcast is forced: Spark decides from the size of each dimension.
    """
    return reduce(
        lambda left, d: left.join(d[0], left[d[1]] == d[0][d[2]], "left"), dimensions, fact
    )


def _sum_when(condition: Column, amount: Column) -> Column:
    return F.sum(F.when(condition, amount))


def signed_totals(
    movements: DataFrame, by: Sequence[str], sign: str, amount: Column, signs: Mapping[str, str]
) -> DataFrame:
    """Count and amount per sign, e.g. ``signs={"+": "in", "-": "out"}``."""
    measures = []
    for value, name in signs.items():
        hit = F.col(sign) == F.lit(value)
        measures += [F.count_if(hit).alias(f"{name}_count"), _sum_when(hit, amount).alias(f"{name}_amount")]
    return movements.groupBy(*by).agg(*measures)


def accounts_by_type(
    accounts: DataFrame, by: Sequence[str], account_type: str, types: Mapping[object, str]
) -> DataFrame:
    return accounts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("accounts_total"),
        *[F.count_if(F.col(account_type) == F.lit(v)).alias(f"accounts_{n}") for v, n in types.items()],
    )


def sign_by_type(
    movements: DataFrame, by: Sequence[str], sign: str, account_type: str, amount: Column,
    signs: Mapping[str, str], types: Mapping[object, str],
) -> DataFrame:
    """Count and amount for every pair of sign and account type, as fixed columns."""
    measures = []
    for s, s_name in signs.items():
        for t, t_name in types.items():
            hit = (F.col(sign) == F.lit(s)) & (F.col(account_type) == F.lit(t))
            measures += [
                F.count_if(hit).alias(f"{s_name}_count_{t_name}"),
                _sum_when(hit, amount).alias(f"{s_name}_amount_{t_name}"),
            ]
    return movements.groupBy(*by).agg(*measures)


def customer_features(
    customers: DataFrame, accounts: DataFrame, movements: DataFrame, *,
    customer_key: str, account_owner: str, account_key: str, movement_account: str,
    account_type: str, types: Mapping[object, str], sign: str, signs: Mapping[str, str],
    amount: str, birth_date: str | None = None, as_of: Column | None = None,
) -> DataFrame:
    """One row per customer: its own columns, an age, and zero-filled features.

    The movements are reduced to one row per account and sign before the only big join,
    so a hot account costs no more than any other. Account counts and movement totals
    then come out of one aggregation per customer. The age is not zero-filled.
    """
    per_account = (
        movements.filter(F.col(movement_account).isNotNull())
        .groupBy(movement_account)
        .agg(*[
            m for value, name in signs.items() for m in (
                F.count_if(F.col(sign) == F.lit(value)).alias(f"_{name}_count"),
                _sum_when(F.col(sign) == F.lit(value), money(F.col(amount))).alias(f"_{name}_amount"),
            )
        ])
    )
    owned = accounts.select(
        F.col(account_key).alias("_account"), F.col(account_owner).alias("_owner"),
        F.col(account_type).alias("_type"),
    ).filter("_owner is not null")
    joined = owned.join(per_account, F.col("_account") == F.col(movement_account), "left")
    measures = [F.count(F.lit(1)).alias("accounts_total")]
    measures += [F.count_if(F.col("_type") == F.lit(v)).alias(f"accounts_{n}") for v, n in types.items()]
    for name in signs.values():
        measures += [F.sum(f"_{name}_count").alias(f"{name}_count"), F.sum(f"_{name}_amount").alias(f"{name}_amount")]
        for v, t in types.items():
            hit = F.col("_type") == F.lit(v)
            measures += [
                _sum_when(hit, F.col(f"_{name}_count")).alias(f"{name}_count_{t}"),
                _sum_when(hit, F.col(f"_{name}_amount")).alias(f"{name}_amount_{t}"),
            ]
    features = joined.groupBy("_owner").agg(*measures)
    spine = customers
    if birth_date is not None:
        spine = spine.withColumn("age", completed_years(F.col(birth_date), as_of))
    wide = spine.join(features, spine[customer_key] == features["_owner"], "left")
    filled = [
        zero_if_null(F.col(c)).cast("double" if "amount" in c else "long").alias(c)
        for c in features.columns if c != "_owner"
    ]
    return wide.select(*[spine[c] for c in spine.columns], *filled)
