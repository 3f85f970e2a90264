"""Whole groups inside sorted Arrow batches.

For many small groups this costs far less than one function call per group: a task gets
its partition sorted by key, and the function gets blocks made of complete groups.
Callers make sure first that no group is larger than one task should hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

GROUP = "_group"


def complete_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Blocks of rows with the start of each group; a group never spans two blocks."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        changes = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if rest and rest[-1][key].iloc[-1] != keys[0]:
            changes = np.concatenate([[0], changes])
        if not len(changes):
            rest.append(batch)
            continue
        last = changes[-1]
        block = pd.concat([*rest, batch.iloc[:last]], ignore_index=True)
        rest = [batch.iloc[last:]]
        yield block, _starts(block, key)
    if rest:
        block = pd.concat(rest, ignore_index=True)
        yield block, _starts(block, key)


def _starts(block: pd.DataFrame, key: str) -> np.ndarray:
    keys = block[key].to_numpy()
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])


def map_groups(
    df: DataFrame, key: str, order: Sequence[Column | str],
    function: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str | object,
) -> DataFrame:
    """Apply ``function(block, starts)`` to blocks of complete groups sorted by ``order``."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, starts in complete_groups(batches, GROUP):
            yield function(block, starts)

    # Groups are told apart by a text that is never null: a null number would reach pandas as NaN, unequal to itself.
    marked = df.withColumn(GROUP, F.coalesce(F.concat(F.lit("+"), F.col(key).cast("string")), F.lit("-")))
    return marked.repartition(GROUP).sortWithinPartitions(GROUP, *order).mapInPandas(work, schema)
