"""Frequent itemsets by depth-first mining of bitmaps, dealt out by prefix.

Baskets of the same items are one basket with a weight; a weight is a sum of powers of two, and each power makes a row of
bits of its own, so that the 64 baskets of a word weigh the same. Items are ranked from rare to frequent, and an itemset
belongs to the prefix of its rarest items. A prefix has a class: the items that are frequent together with it, and the
baskets that hold it. A class whose rows and bitmaps (a bit per item and basket) fit into a task is mined there, depth
first, with difference sets: the baskets that an item loses when the prefix grows, which get fewer with every step. A larger
class is extended by one item on all executors, by joins and counts, and its longer prefixes are dealt out anew. Since
rare items come first, an item in most baskets is never a prefix with much behind it, and a basket of very many items is
one bit in each of their bitmaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.operators.ordered import running
from tessera.operators.vocabulary import small
from tessera.session import written

MATRIX = 64 << 20  # bytes of a class's bitmaps in a task
ROWS = 1_000_000  # rows of a class in a task, 20 bytes each


def _places(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bit of each basket, and the weight of each word of 64 bits: baskets of one weight fill words of their own."""
    kinds, kind_of, counts = np.unique(weights, return_inverse=True, return_counts=True)
    words = -(-counts // 64)
    order = np.argsort(kind_of, kind="stable")
    places = np.empty(len(weights), np.int64)
    places[order] = np.arange(len(weights)) + np.repeat(64 * (np.cumsum(words) - words) - (np.cumsum(counts) - counts), counts)
    return places, np.repeat(kinds, words).astype(np.float64)


def _bitmaps(places: np.ndarray, item_of: np.ndarray, items: int, words: int) -> np.ndarray:
    """A row of 64-bit words per item; ``item_of`` are numbers from 0."""
    rows = np.zeros((items, words * 8), np.uint8)
    order = np.argsort(item_of, kind="stable")
    ends = np.searchsorted(item_of[order], np.arange(items + 1))
    for i in range(items):
        here = np.zeros(words * 64, bool)
        here[places[order[ends[i]:ends[i + 1]]]] = True
        rows[i] = np.packbits(here)
    return rows.view(np.uint64)


def _deeper(prefix: list[int], items: np.ndarray, bits: np.ndarray, weights: np.ndarray, counts: np.ndarray, least: int,
            differences: bool = False) -> Iterator[tuple[list[int], int]]:
    """Itemsets with two or more of ``items`` behind the prefix; ``bits`` are baskets, or what is lost against the prefix."""
    for i in range(len(items) - 1):
        lost = bits[i + 1:] & ~bits[i] if differences else bits[i] & ~bits[i + 1:]
        n = counts[i] - np.bitwise_count(lost) @ weights
        kept = n >= least
        if not kept.any():
            continue
        longer, last, n = [*prefix, int(items[i])], items[i + 1:][kept], n[kept]
        for item, count in zip(last.tolist(), n.tolist()):
            yield [*longer, item], int(count)
        if len(last) > 1:
            lost = lost[kept]
            used = lost.any(axis=0)
            yield from _deeper(longer, last, lost[:, used], weights[used], n, least, True)


def _mined(item: np.ndarray, basket: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[list[int], int]]:
    """Itemsets of two or more items of one class."""
    items, item_of = np.unique(item, return_inverse=True)
    _, first, basket_of = np.unique(basket, return_index=True, return_inverse=True)
    places, weights = _places(weight[first])
    bits = _bitmaps(places[basket_of], item_of, len(items), len(weights))
    return _deeper([], items, bits, weights, np.bitwise_count(bits) @ weights, least)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Class, items, baskets and weights of each class out of rows that are sorted by class."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[c].to_numpy() for c in ("class", "item", "basket", "weight")]
        cuts = [0, *(np.flatnonzero(np.diff(columns[0])) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if held and held[-1][0][0] != columns[0][start]:
                yield _joined(held)
                held = []
            held.append([c[start:end] for c in columns])
    if held:
        yield _joined(held)


def _joined(parts: list[list[np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    item, basket, weight = (np.concatenate(c) for c in list(zip(*parts))[1:])
    return int(parts[0][0][0]), item, basket, weight


def _mine_classes(rows: DataFrame, least: int) -> DataFrame:
    """``class, ranks, n`` of the itemsets that ``class, item, basket, weight`` hold behind the prefix of each class."""
    schema = pa.schema([("class", pa.int64()), ("ranks", pa.list_(pa.int32())), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, list[int], int]] = []
        for number, *columns in _classes(batches):
            for ranks, n in _mined(*columns, least):
                found.append((number, ranks, n))
                if len(found) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                    found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    numbers = rows.select("class", "item", "basket", "weight")
    return numbers.repartition("class").sortWithinPartitions("class").mapInArrow(work, "class bigint, ranks array<int>, n bigint")


def _alike(held: DataFrame) -> DataFrame:
    """``basket, weight, item`` of baskets with two items or more, from distinct ``document, item``: each set of items once for
    each power of two in the number of documents that hold just these. Sets are told apart by 128 bits of their items' hashes.
    """
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "item")).alias(f"_mark_{seed}") for seed in (1, 2)]
    sets = held.groupBy("document").agg(F.count(F.lit(1)).alias("_width"), *marks).filter("_width > 1").groupBy(
        "_width", "_mark_1", "_mark_2").agg(F.min("document").alias("document"), F.count(F.lit(1)).alias("_times"))
    powers = F.expr("filter(transform(sequence(0, 62), k -> shiftleft(1L, k)), p -> (_times & p) <> 0)")
    sets = written(sets.select("document", F.explode(powers).alias("weight")).withColumn(
        "basket", F.monotonically_increasing_id()), "baskets")
    return held.join(small(sets), "document").select("basket", "weight", "item")


def mine(pairs: DataFrame, min_count: int, matrix: int = MATRIX, most: int = ROWS) -> DataFrame:
    """``items, n`` of every itemset that at least ``min_count`` baskets hold, from distinct pairs ``document, item``.

    ``items`` is sorted. Neither column may be null. ``matrix`` and ``most`` decide where a class is mined, never the result.
    """
    least = max(min_count, 1)
    counts = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    names = written(running(counts, ["n", "item"], rank="_rank").select(
        F.col("_rank").cast("int").alias("rank"), F.col("item").alias("name"), F.col("n").cast("long").alias("n")), "items")
    held = written(pairs.join(names, pairs["item"] == names["name"]).select("document", F.col("rank").alias("item")), "held")
    none = F.array().cast("array<int>")
    large = written(_alike(held).select(none.alias("prefix"), "basket", "weight", "item"), "rows")
    found = [names.select(F.array("rank").alias("ranks"), "n")]
    while True:
        a = large.select("prefix", "basket", "weight", F.col("item").alias("_a"))
        b = large.select("prefix", "basket", F.col("item").alias("_b"))
        longer = written(a.join(b, ["prefix", "basket"]).filter("_a < _b").select(
            F.concat("prefix", F.array("_a")).alias("prefix"), "basket", "weight", F.col("_b").alias("item")), "rows")
        together = written(longer.groupBy("prefix", "item").agg(
            F.sum("weight").alias("n"), F.count(F.lit(1)).alias("_rows")).filter(F.col("n") >= least), "together")
        found.append(together.select(F.concat("prefix", F.array("item")).alias("ranks"), "n"))
        # a prefix with one item behind it is done; the baskets that matter are at most the sum of the items' rows
        classes = together.groupBy("prefix").agg(
            F.count(F.lit(1)).alias("_items"), F.sum("_rows").alias("_baskets")).filter("_items > 1")
        tall = (F.col("_items") * F.col("_baskets") > 8 * matrix) | (F.col("_baskets") > most)
        classes = written(classes.select("prefix", tall.alias("_large"), F.monotonically_increasing_id().alias("class")), "classes")
        kept = longer.join(together.select("prefix", "item"), ["prefix", "item"], "left_semi").join(classes, "prefix")
        kept = written(kept, "rows")
        behind = _mine_classes(kept.filter("not _large"), least)
        found.append(behind.join(classes, "class").select(F.concat("prefix", "ranks").alias("ranks"), "n"))
        large = kept.filter("_large").select("prefix", "basket", "weight", "item")
        if large.isEmpty():
            break
    itemsets = found[0]
    for more in found[1:]:
        itemsets = itemsets.unionByName(more)
    itemsets = written(itemsets, "itemsets").withColumn("_id", F.monotonically_increasing_id())
    spelled = itemsets.select("_id", "n", F.explode("ranks").alias("rank")).join(names.select("rank", "name"), "rank")
    return spelled.groupBy("_id", "n").agg(F.array_sort(F.collect_list("name")).alias("items")).select("items", "n")
