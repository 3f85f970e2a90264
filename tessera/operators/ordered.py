"""Running sums, ranks and lags over a total order.

A window without a partition key puts all rows into one task, and a window over a
hot key puts that key into one task. Here rows are range-partitioned on
``(by, order)`` instead, so that a hot group is spread over many slices. Each slice
computes its own running values, and a table of at most one row per slice carries
the totals of the slices before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.session import shuffle_width, written

SLICE = "_slice"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], renamed: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(keys, renamed):
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def running(
    df: DataFrame,
    order: Sequence[Column | str],
    by: Sequence[str] = (),
    sums: Mapping[str, str] | None = None,
    rank: str | None = None,
) -> DataFrame:
    """Add a 1-based ``rank`` and inclusive running ``sums`` (output name -> column).

    ``order`` together with ``by`` must be a total order.
    """
    sums = dict(sums or {})
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    by = list(by)
    cut = written(
        df.repartitionByRange(shuffle_width(df.sparkSession), *[F.col(b) for b in by], *order)
        .withColumn(SLICE, F.spark_partition_id()),
        "slices",
    )
    totals = cut.groupBy(*by, SLICE).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{i}") for i, c in enumerate(sums.values())],
    )
    if by:
        # Slices are sorted by group, so at most one group continues into each slice.
        spans = totals.groupBy(*by).agg(F.min(SLICE).alias("_first"), F.max(SLICE).alias("_last"))
        names = [f"_by_{i}" for i in range(len(by))]
        spans = spans.filter("_first < _last").select(*[F.col(b).alias(n) for b, n in zip(by, names)])
        totals = totals.join(spans, _same(totals, spans, by, names), "left_semi")
        before = W.partitionBy(*by).orderBy(SLICE)
    else:
        before = W.orderBy(SLICE)
    before = before.rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(b).alias(f"_k_{i}") for i, b in enumerate(by)],
        F.col(SLICE).alias("_k_slice"),
        F.sum("_n").over(before).alias("_n_before"),
        *[F.sum(f"_sum_{i}").over(before).alias(f"_before_{i}") for i in range(len(sums))],
    )
    inside = W.partitionBy(*by, SLICE).orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    local = cut.select(
        "*",
        F.row_number().over(inside).cast("long").alias("_local_rank"),
        *[F.sum(c).over(upto).alias(f"_local_{i}") for i, c in enumerate(sums.values())],
    )
    on = _same(local, carried, [*by, SLICE], [*[f"_k_{i}" for i in range(len(by))], "_k_slice"])
    joined = local.join(F.broadcast(carried), on, "left")  # <= one row per slice
    out = [c for c in df.columns]
    added = []
    if rank:
        added.append((F.col("_local_rank") + F.coalesce("_n_before", F.lit(0))).alias(rank))
    for i, name in enumerate(sums):
        here, earlier = F.col(f"_local_{i}"), F.col(f"_before_{i}")
        added.append(F.when(earlier.isNull(), here).otherwise(F.coalesce(here, here * 0 + 0, earlier * 0) + earlier).alias(name))
    return joined.select(*out, *added)


def lagged(
    df: DataFrame,
    order: Sequence[str],
    columns: Mapping[str, tuple[str, int]],
    by: Sequence[str] = (),
    block: int = 1 << 20,
) -> DataFrame:
    """Add ``name -> (column, k)``: the value ``k`` rows earlier in the whole order.

    Rows are cut into blocks of consecutive ranks; the last rows of a block also travel
    to the next one as context, so no window sees more than one block.
    """
    reach = max(k for _, k in columns.values())
    if reach >= block:
        raise ValueError("block must be longer than the longest lag")
    ranked = running(df, order, by, rank="_rank").withColumn("_block", F.floor((F.col("_rank") - 1) / block))
    tail = (F.col("_rank") - 1) % block >= block - reach
    spread = ranked.withColumn(
        "_target",
        F.explode(F.when(tail, F.array("_block", F.col("_block") + 1)).otherwise(F.array("_block"))),
    )
    window = W.partitionBy(*by, "_target").orderBy("_rank")
    shifted = spread.select(
        "*", *[F.lag(c, k).over(window).alias(name) for name, (c, k) in columns.items()]
    )
    return shifted.filter("_target = _block").drop("_rank", "_block", "_target")
