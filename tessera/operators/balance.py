"""Repeatable random splits, stratified splits, under- and over-sampling.

Randomness is an md5 of the row id and a seed, so a result does not depend on how rows
are partitioned and can be repeated after a lost executor. Exact counts are reached by
ranking only the ids; the wide rows are then filtered against the boundary id.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.ordered import running
from tessera.operators.vocabulary import small
from tessera.session import written


def seeded(row_id: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed))))


def with_first(
    df: DataFrame, row_id: str, seed: int, wanted: Callable[[Column], Column], by: Sequence[str] = (),
    flag: str = "chosen",
) -> DataFrame:
    """Flag the ``wanted(n)`` rows of each group that come first in seeded order."""
    by = list(by)
    keys = df.select(*by, F.col(row_id).alias("_id"), seeded(row_id, seed).alias("_hash"))
    ranked = running(keys, ["_hash", "_id"], by, rank="_rank")
    names = [f"_by_{i}" for i in range(len(by))]
    sizes = ranked.groupBy(*[F.col(b).alias(n) for b, n in zip(by, names)]).agg(
        wanted(F.max("_rank")).cast("long").alias("_wanted"))
    if by:
        limits = ranked.join(
            sizes, [ranked[b].eqNullSafe(sizes[n]) for b, n in zip(by, names)] + [ranked["_rank"] == sizes["_wanted"]]
        ).select(*names, F.struct(F.col("_hash").alias("h"), F.col("_id").alias("i")).alias("_limit"))
        limits = small(written(limits, "limits"))
        joined = df.join(limits, [df[b].eqNullSafe(limits[n]) for b, n in zip(by, names)], "left")
    else:
        limit = ranked.filter(F.col("_rank") == sizes.select("_wanted").scalar()).select(
            F.struct(F.col("_hash").alias("h"), F.col("_id").alias("i")))
        joined = df.withColumn("_limit", limit.scalar())
    here = F.struct(seeded(row_id, seed).alias("h"), F.col(row_id).alias("i"))
    return joined.withColumn(flag, F.coalesce(here <= F.col("_limit"), F.lit(False))).select(*df.columns, flag)


def random_split(df: DataFrame, row_id: str, test_share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test), where test has exactly ``ceil(n * test_share)`` rows."""
    marked = with_first(df, row_id, seed, lambda n: F.ceil(n * F.lit(test_share)))
    return marked.filter(~F.col("chosen")).drop("chosen"), marked.filter("chosen").drop("chosen")


def three_way_split(
    df: DataFrame, row_id: str, held_out: float = 0.3, seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test): a share is held out, and half of it becomes the test set."""
    train, rest = random_split(df, row_id, held_out, seed)
    validation, test = random_split(rest, row_id, 0.5, seed + 1)
    return train, validation, test


def stratified_split(
    df: DataFrame, row_id: str, label: str, test_share: float, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Like ``random_split``, with the rounded share taken inside every label."""
    marked = with_first(df, row_id, seed, lambda n: F.floor(n * F.lit(test_share) + 0.5), [label])
    return marked.filter(~F.col("chosen")).drop("chosen"), marked.filter("chosen").drop("chosen")


def undersample_negatives(
    df: DataFrame, row_id: str, labels: Sequence[str], keep_ratio: float, seed: int = 42
) -> DataFrame:
    """All rows with a label, and exactly ``floor(n * keep_ratio)`` of the rows without any."""
    none = sum((F.coalesce(F.col(c), F.lit(0)) for c in labels), F.lit(0)) == 0
    kept = with_first(df.filter(none), row_id, seed, lambda n: F.floor(n * F.lit(keep_ratio)))
    return df.filter(~none).unionByName(kept.filter("chosen").drop("chosen"))


def oversample(df: DataFrame, factors: Mapping[str, int]) -> DataFrame:
    """Repeat each row as often as the largest factor among its labels."""
    times = F.greatest(F.lit(1), *[F.when(F.col(c) == 1, F.lit(int(f))).otherwise(F.lit(1)) for c, f in factors.items()])
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def sample_rows(df: DataFrame, row_id: str, rows: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of exactly ``rows`` rows."""
    return df.orderBy(seeded(row_id, seed), row_id).limit(rows)
