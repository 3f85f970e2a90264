"""Mixing sources to target weights by temperature.

The token share ``p`` of a source is raised to an exponent between 0 (all sources alike) and 1 (as found)
and normalised. The exponent is bisected: the largest one that reaches the wanted entropy, or the smallest
one that keeps the repetitions of every source within a limit, whichever is larger. The budget that the
weights share out is by default the least with which every document is used once.

A source's documents fall into blocks by hash. A source goes through all its blocks as often as its
budget holds them; what is left is filled in a further pass with the first blocks of that pass's
permutation, the last of them cut inside at a document. So a source's schedule follows from sums per block, and
no source is ever sorted or gathered as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.llm.support import WORD
from tessera.operators.ordered import running
from tessera.session import written

EXPONENTS = 64  # exponents that one pass over the sources tries at once


def word_tokens(text: Column) -> Column:
    """White-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class Shares:
    """The token shares of all sources as a table ``_key, _n``, one row per source; only sums over it come to the driver."""

    def __init__(self, totals: DataFrame):
        some = totals.filter("_n > 0")
        row = some.agg(F.count("_n"), F.sum("_n"), F.min("_n"), F.max("_n")).first()
        self.count, self.total, self.least, self.most = row[0], int(row[1] or 0), row[2], row[3]
        self.log = F.log(F.col("_n") / F.lit(float(max(self.total, 1))))
        self.logs = some.select(self.log.alias("log"))

    def sums(self, exponents: list[float]) -> list[tuple[float, float]]:
        """For each exponent the sum of all shares' powers, and that of the powers times the logarithm of the share."""
        power = F.exp(F.col("x") * F.col("log"))
        rows = self.logs.select("log", F.explode(F.array(*map(F.lit, exponents))).alias("x")).groupBy("x").agg(
            F.sum(power).alias("powers"), F.sum(power * F.col("log")).alias("logs")).collect()
        found = {r["x"]: (r["powers"], r["logs"]) for r in rows}
        return [found[x] for x in exponents]

    def spread(self, exponents: list[float]) -> list[float]:
        """The entropy of the weights, as a share of the highest possible one."""
        if self.count < 2:
            return [1.0] * len(exponents)
        return [(math.log(z) - x * s / z) / math.log(self.count) for x, (z, s) in zip(exponents, self.sums(exponents))]

    def most_repeats(self, exponents: list[float], budget: float | None) -> list[float]:
        """How often the source with the fewest tokens is used; exponents are at most 1, so no other is used more often.

        Without a budget the source with the most tokens is used once."""
        if budget is None:
            return [(self.least / self.most) ** (x - 1) for x in exponents]
        low = self.least / self.total
        return [budget * low ** (x - 1) / z / self.total for x, (z, _) in zip(exponents, self.sums(exponents))]

    def exponent(self, entropy: float | None, repeats: float | None, budget: float | None) -> float:
        """The largest exponent that reaches ``entropy``, or the smallest above it that keeps to ``repeats``; 0 to 1."""
        exponent = 1.0
        if entropy is not None and self.spread([1.0])[0] < entropy:
            exponent = _bisect(lambda xs: [v >= entropy for v in self.spread(xs)])[0]
        if repeats is not None and self.most_repeats([exponent], budget)[0] > repeats:
            exponent = _bisect(lambda xs: [v > repeats for v in self.most_repeats(xs, budget)], exponent)[1]
        return exponent

    def plan(self, totals: DataFrame, entropy: float | None, repeats: float | None, budget: float | None) -> DataFrame:
        """``_key, _weight, _passes, _rest`` per source: whole passes and the tokens of a last one; without tokens one pass."""
        if not self.count:
            return totals.select("_key", F.lit(0.0).alias("_weight"), F.lit(1).cast("long").alias("_passes"), F.lit(0).cast("long").alias("_rest"))
        exponent = self.exponent(entropy, repeats, budget)
        powers = self.sums([exponent])[0][0]
        total = budget if budget is not None else powers * self.total * (self.most / self.total) ** (1 - exponent)
        n, weight = F.col("_n"), F.exp(F.lit(exponent) * self.log) / F.lit(powers)
        share = F.floor(weight * F.lit(float(total)) + 1e-6 * n).cast("long")  # a pass that rounding has cut short is whole
        rest = share % n
        some = n > 0
        return totals.select(
            "_key", F.when(some, weight).otherwise(0.0).alias("_weight"),
            F.when(some, F.floor(share / n)).otherwise(1).cast("long").alias("_passes"),
            F.when(some & (rest > 2e-6 * n), rest).otherwise(0).cast("long").alias("_rest"))


def _bisect(holds_low, low: float = 0.0, high: float = 1.0) -> tuple[float, float]:
    """The ends of the interval in which a property that holds at ``low`` stops, cut into many parts at a time."""
    while high - low > 1e-13:
        steps = [low + (high - low) * i / (EXPONENTS + 1) for i in range(1, EXPONENTS + 1)]
        held = holds_low(steps)
        n = held.index(False) if False in held else len(held)
        low, high = steps[n - 1] if n else low, steps[n] if n < len(steps) else high
    return low, high


class Mixture:
    """Which documents are used how often; see ``fit``."""

    def __init__(self, blocks: DataFrame, n_blocks: int, seed: int):
        self.blocks, self.n_blocks, self.seed = blocks, n_blocks, seed

    def apply(self, docs: DataFrame, **extra: Column) -> DataFrame:
        """Every row as often as planned, all its columns under any names, with ``extra`` ones made from
        ``_key, _block, _epoch``, which are not in the result."""
        row = _row_hash(docs, self.seed)
        keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_all"), _key(docs).alias("_key"),
                            row.alias("_row"), F.pmod(row, F.lit(self.n_blocks)).alias("_block"))
        joined = keyed.join(self.blocks, ["_key", "_block"])
        further = F.coalesce(F.col("_whole") | (F.col("_row") <= F.col("_upto")), F.lit(False))
        times = F.col("_passes") + further.cast("int")
        used = joined.filter(times > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0), (times - 1).cast("int"))))
        return used.select("_all.*", *[c.alias(n) for n, c in extra.items()])


def _key(docs: DataFrame) -> Column:
    """A source as text that is never null: the null source is one of its own."""
    return F.when(docs["source"].isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), docs["source"]))


def _row_hash(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"], F.lit(seed))


def fit(docs: DataFrame, entropy: float | None = 0.9, repeats: float | None = 4.0, budget: float | None = None,
        block_rows: int = 4096, seed: int = 7) -> Mixture:
    """Plan a mixture of ``docs`` (``doc_id, text, source``).

    Rows equal in all of these share their place, so the cut inside a block never parts them. A null text has no tokens;
    an empty table gives an empty plan. Sources stay in a table of one row each; their number has no limit.
    """
    rows = written(docs.select(_key(docs).alias("_key"), _row_hash(docs, seed).alias("_row"),
                               word_tokens(docs["text"]).alias("_n")), "tokens")
    n_blocks = max(1, math.ceil(rows.count() / block_rows))
    rows = rows.withColumn("_block", F.pmod("_row", F.lit(n_blocks)))
    blocks = written(rows.groupBy("_key", "_block").agg(F.sum("_n").alias("_n")), "blocks")
    totals = written(blocks.groupBy("_key").agg(F.sum("_n").alias("_n")), "totals")
    sources = Shares(totals).plan(totals, entropy, repeats, budget)
    order = F.xxhash64("_key", "_block", F.lit(seed), F.lit("further pass"))
    placed = running(blocks.join(sources, "_key").withColumn("_order", order), ["_order", "_block"], ["_key"], {"_upto_n": "_n"})
    placed = written(placed.withColumn("_whole", (F.col("_rest") > 0) & (F.col("_upto_n") <= F.col("_rest"))), "placed")
    # The one block per source in which the last pass ends.
    last = placed.filter((F.col("_upto_n") > F.col("_rest")) & (F.col("_upto_n") - F.col("_n") < F.col("_rest")))
    last = last.select("_key", "_block", (F.col("_rest") - F.col("_upto_n") + F.col("_n")).alias("_left"))
    inside = rows.groupBy("_key", "_block", "_row").agg(F.sum("_n").alias("_n")).join(last, ["_key", "_block"])
    inside = inside.withColumn("_sum", F.sum("_n").over(W.partitionBy("_key").orderBy("_row")))
    cut = inside.filter("_sum <= _left").groupBy("_key", "_block").agg(F.max("_row").alias("_upto"))
    table = placed.join(cut, ["_key", "_block"], "left").select(
        "_key", "_block", F.col("_passes").cast("int").alias("_passes"), "_whole", "_upto")
    return Mixture(written(table, "mixture"), n_blocks, seed)


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, source, epoch, block, block_order``: every use of every document.

    Read by ``epoch``, then ``block_order`` (the epoch's permutation of all sources' blocks together), the rows are
    the training order.
    """
    mixture = fit(docs, **options)
    source = docs.select("doc_id", "text", "source")
    order = F.xxhash64("_key", "_block", F.lit(mixture.seed), F.col("_epoch"))
    return mixture.apply(source, epoch=F.col("_epoch").cast("int"), block=F.col("_block"), block_order=order).drop("text")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, all columns, each as often as planned."""
    return fit(docs, **options).apply(docs)
