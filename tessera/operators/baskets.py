"""Baskets, frequent itemsets and one-to-one association rules."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from tessera.operators.itemsets import mine
from tessera.session import written

TASK_ROWS = 500_000  # items of whole baskets that a task pairs


def basket_items(df: DataFrame, document: str, item: str) -> DataFrame:
    """Distinct (document, item) pairs; null items are left out."""
    return df.filter(F.col(item).isNotNull()).select(
        F.col(document).alias("document"), F.col(item).alias("item")).distinct()


def basket_count(df: DataFrame, document: str) -> DataFrame:
    """Number of documents, one row; a document without any item still counts."""
    return df.select(document).distinct().agg(F.count(F.lit(1)).alias("baskets"))


def baskets(df: DataFrame, document: str, item: str) -> DataFrame:
    """One row per document: the sorted array of its distinct items, empty if all its items are null.

    For baskets that are too large for a row, ``basket_items`` gives the same as (document, item) rows.
    """
    pairs = df.select(F.col(document).alias("document"), F.col(item).alias("item")).distinct()
    return pairs.groupBy("document").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _keyed(df: DataFrame, document: str, item: str) -> DataFrame:
    """``basket_items`` with documents as text that is never null: the null document is one basket."""
    key = F.coalesce(F.concat(F.lit("+"), F.col("document").cast("string")), F.lit("-"))
    return basket_items(df, document, item).select(key.alias("document"), "item")


def relative_support(min_count: int, transactions: int) -> float:
    """Support fraction that the miner turns back into exactly ``min_count`` transactions."""
    if transactions <= 0:
        raise ValueError("no transactions")
    return (min_count - 0.5) / transactions


def _frequent(pairs: DataFrame, min_count: int) -> DataFrame:
    return pairs.groupBy("item").agg(F.count(F.lit(1)).alias("item_count")).filter(F.col("item_count") >= min_count)


def _pruned_baskets(df: DataFrame, document: str, item: str, min_count: int) -> DataFrame:
    pairs = written(_keyed(df, document, item), "pairs")
    kept = pairs.join(_frequent(pairs, min_count).select("item"), "item", "left_semi")
    return kept.groupBy("document").agg(F.collect_set("item").alias("items"))


def _fitted(df, document, item, min_count, min_confidence):
    """(fitted miner, number of baskets it has seen)."""
    rows = written(_pruned_baskets(df, document, item, min_count).select("items"), "baskets")
    found = rows.count()
    miner = FPGrowth(
        itemsCol="items", minSupport=relative_support(min_count, found) if found else 1.0, minConfidence=min_confidence)
    return miner.fit(rows), found


def frequent_itemsets(df: DataFrame, document: str, item: str, min_count: int) -> DataFrame:
    """``items, n``: all itemsets in at least ``min_count`` baskets."""
    return mine(written(_keyed(df, document, item), "pairs"), min_count)


def mined_pair_rules(df: DataFrame, document: str, item: str, min_count: int, min_confidence: float) -> DataFrame:
    """One-to-one rules out of the itemset miner; ``pair_rules`` gives the same rows at scale.

    The miner mines anew for each use of its itemsets, and its own rules use them twice and join all of them. So they
    are mined once, their pairs and single items are written, and the rules of the pairs are made from these counts.
    Support and lift refer to the number of all baskets, while the miner sees only baskets with a frequent item.
    """
    model, _ = _fitted(df, document, item, min_count, min_confidence)
    total = basket_count(df, document).scalar()
    found = written(model.freqItemsets.filter(F.size("items") <= 2), "itemsets")
    single = found.filter(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    pairs = found.filter(F.size("items") == 2)
    directed = pairs.select("freq", F.inline(F.array(*[
        F.struct(F.col("items")[i].alias("antecedent"), F.col("items")[1 - i].alias("consequent")) for i in (0, 1)])))
    confidence = F.col("freq") / F.col("_na")
    return directed.join(single.select(F.col("item").alias("antecedent"), F.col("freq").alias("_na")), "antecedent").join(
        single.select(F.col("item").alias("consequent"), F.col("freq").alias("_nc")), "consequent").select(
        "antecedent", "consequent", confidence.alias("confidence"), (confidence / (F.col("_nc") / total)).alias("lift"),
        (F.col("freq") / total).alias("support")).filter(F.col("confidence") >= min_confidence)


def pair_rules(
    df: DataFrame, document: str, item: str, min_count: int, min_confidence: float, wide: int = 1000,
) -> DataFrame:
    """Rules ``antecedent -> consequent`` with confidence, lift and support.

    Only items in at least ``min_count`` baskets are paired. Very wide baskets are kept
    out of the pairing: a pair found in ``min_count`` baskets must also occur in one that is
    not among the ``min_count - 1`` widest, so those only add to pairs found elsewhere, by
    looking up the baskets of both items. Wide baskets beyond that number are paired in
    pieces, so that no task pairs a whole one. Pairing is dealt to tasks by the number of rows, about ``TASK_ROWS`` each,
    since rows to be sorted take many times their shuffled size.
    """
    pairs = written(_keyed(df, document, item), "pairs")
    counts = written(_frequent(pairs, min_count), "counts")
    kept = written(pairs.join(counts.select("item"), "item", "left_semi"), "frequent")
    tasks = max(kept.sparkSession.sparkContext.defaultParallelism, math.ceil(kept.count() / TASK_ROWS))
    widths = kept.groupBy("document").agg(F.count(F.lit(1)).alias("width")).filter(F.col("width") > wide)
    looked_up = [r["document"] for r in widths.orderBy(F.desc("width"), "document").limit(min(min_count - 1, 1000)).collect()]

    narrow = kept.filter(~F.col("document").isin(looked_up)) if looked_up else kept
    if len(looked_up) == min(min_count - 1, 1000):  # wide baskets may be left over
        pieces = widths.select("document", F.ceil(F.col("width") / wide).cast("int").alias("pieces"))
        cut = narrow.join(pieces, "document", "left").fillna(1, ["pieces"])
        left = cut.select("document", F.col("item").alias("first"),
                          F.pmod(F.xxhash64("item"), F.col("pieces")).cast("int").alias("piece"))
        right = cut.select("document", F.col("item").alias("second"),
                           F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
        met = left.repartition(tasks, "document", "piece").join(right.repartition(tasks, "document", "piece"), ["document", "piece"])
    else:
        dealt = narrow.repartition(tasks, "document")
        met = dealt.select("document", F.col("item").alias("first")).join(
            dealt.select("document", F.col("item").alias("second")), "document")
    together = met.filter("first < second").groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    if looked_up:
        together = together.filter(F.col("n") + len(looked_up) >= min_count)
        where = kept.filter(F.col("document").isin(looked_up)).groupBy("item").agg(
            F.collect_set("document").alias("documents"))  # at most min_count - 1 or 1000 entries
        together = (
            together.join(where.select(F.col("item").alias("first"), F.col("documents").alias("_a")), "first", "left")
            .join(where.select(F.col("item").alias("second"), F.col("documents").alias("_b")), "second", "left")
            .withColumn("n", F.col("n") + F.coalesce(F.size(F.array_intersect("_a", "_b")), F.lit(0)))
        )
    together = together.filter(F.col("n") >= min_count)
    ends = F.array(
        F.struct(F.col("first").alias("antecedent"), F.col("second").alias("consequent")),
        F.struct(F.col("second").alias("antecedent"), F.col("first").alias("consequent")))
    directed = together.select("n", F.inline(ends))
    of_antecedent = counts.select(F.col("item").alias("antecedent"), F.col("item_count").alias("_na"))
    of_consequent = counts.select(F.col("item").alias("consequent"), F.col("item_count").alias("_nc"))
    total = basket_count(df, document).scalar()
    rules = directed.join(of_antecedent, "antecedent").join(of_consequent, "consequent")
    confidence = F.col("n") / F.col("_na")
    return rules.select(
        "antecedent", "consequent", confidence.alias("confidence"),
        (confidence / (F.col("_nc") / total)).alias("lift"), (F.col("n") / total).alias("support"),
    ).filter(F.col("confidence") >= min_confidence)
