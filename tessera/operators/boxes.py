"""Box overlap pairs and non-maximum suppression."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.operators.graph import components
from tessera.operators.grouped import map_groups
from tessera.session import written

BOX = ["image", "box", "x", "y", "w", "h"]
CELL = ["_image", "_level", "_tx", "_ty"]
BLOCK = 1000  # boxes of one tile that meet the boxes of another block in one group


def _whole(boxes: DataFrame) -> DataFrame:
    """Boxes with a place, with a text for the image that is never null and the level of their size.

    The tiles of level ``k`` are squares of ``2^k`` pixels; a box's own level is the first whose tiles are as wide and
    high as the box, so that it touches at most four of them.
    """
    side = F.greatest("w", "h").cast("double") + 1
    return boxes.select(*BOX).dropna(subset=["x", "y", "w", "h"]).withColumns({
        "_image": F.coalesce(F.concat(F.lit("+"), F.col("image").cast("string")), F.lit("-")),
        "_own": F.greatest(F.ceil(F.log2(F.greatest(side, F.lit(1.0)))).cast("int"), F.lit(0))})


def _placed(boxes: DataFrame, levels: list[int]) -> DataFrame:
    """A row for every tile that a box touches, on its own level and the larger ones in use."""
    size = F.pow(F.lit(2.0), F.col("_level"))

    def tiles(start: str, length: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(start) / size), F.floor((F.col(start) + F.col(length)) / size)))

    larger = F.filter(F.lit(levels).cast("array<int>"), lambda level: level >= F.col("_own"))
    return boxes.withColumn("_level", F.explode(larger)).withColumn("_tx", tiles("x", "w")).withColumn("_ty", tiles("y", "h"))


def _crowds(placed: DataFrame, name: str) -> DataFrame:
    """Tiles with more than ``BLOCK`` rows, and the number of blocks to cut them into."""
    return placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > BLOCK).select(
        *CELL, F.ceil(F.col("_n") / BLOCK).cast("int").alias(name))


def _joined(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of ``a`` with all rows of ``b`` in the same tile; columns end in _a and _b.

    A crowded tile is cut into blocks on both sides, and every pair of blocks is a join key of its own.
    """
    crowds = [_crowds(a, "_rows"), _crowds(b, "_columns")]

    def cut(side: DataFrame, own: str, other: str) -> DataFrame:
        counted = reduce(lambda df, crowd: df.join(crowd, CELL, "left"), crowds, side).fillna(1, ["_rows", "_columns"])
        return counted.withColumn(own[1:2] + "_block", F.pmod(F.xxhash64("box"), F.col(own)).cast("int")).withColumn(
            other[1:2] + "_block", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_rows", "_columns")

    columns = [*BOX[1:], "_own"]
    keys = [*CELL, "r_block", "c_block"]
    left = cut(a, "_rows", "_columns").select(*keys, "image", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = cut(b, "_columns", "_rows").select(*keys, *[F.col(c).alias(f"{c}_b") for c in columns])
    return left.join(right, keys)


def meetings(a: DataFrame, b: DataFrame | None = None) -> DataFrame:
    """Pairs of a box of ``a`` and one of ``b`` that share pixels, or all such pairs within ``a``, each once.

    The columns are image, those of both boxes with endings _a and _b, and the shared area ``shared``. Two boxes meet
    on the level of the larger one, so a tile is never much larger than the boxes it is for, whatever sizes an image
    holds, and are reported by the tile that holds the corner of the shared area. Only boxes of a tile's own level
    meet the others there; smaller ones meet each other on their own levels.
    """
    alone, a = b is None, _whole(a)
    b = a if alone else _whole(b)
    levels = sorted(r[0] for r in a.select("_own").union(b.select("_own")).distinct().collect())  # at most 64 numbers
    a, b = _placed(a, levels), _placed(b, levels)
    here = F.col("_own") == F.col("_level")
    met = _joined(a.filter(here), b)
    if alone:
        met = met.filter("_own_a <> _own_b or box_a < box_b")
    else:
        met = met.unionByName(_joined(a.filter(~here), b.filter(here)))
    left, top = F.greatest("x_a", "x_b"), F.greatest("y_a", "y_b")
    width = F.least(F.col("x_a") + F.col("w_a"), F.col("x_b") + F.col("w_b")) - left + 1
    height = F.least(F.col("y_a") + F.col("h_a"), F.col("y_b") + F.col("h_b")) - top + 1
    size = F.pow(F.lit(2.0), F.col("_level"))
    return met.filter(
        (width > 0) & (height > 0) & (F.floor(left / size) == F.col("_tx")) & (F.floor(top / size) == F.col("_ty"))
    ).withColumn("shared", width * height).drop(*CELL[1:], "r_block", "c_block")


def _area(suffix: str = "") -> Column:
    return (F.col(f"w{suffix}") + 1) * (F.col(f"h{suffix}") + 1)


def overlaps(boxes: DataFrame) -> DataFrame:
    """Pairs of boxes of one image that share pixels, with the shared area and both areas.

    ``boxes`` has columns image, box (unique in an image), x, y, w, h, with both edges inside the box. Boxes without
    a place overlap nothing; boxes without an image are on one image. No image is paired as a whole.
    """
    ahead = F.col("box_a") < F.col("box_b")
    return meetings(boxes).select(
        "image", F.least("box_a", "box_b").alias("first"), F.greatest("box_a", "box_b").alias("second"), "shared",
        F.when(ahead, _area("_a")).otherwise(_area("_b")).alias("first_area"),
        F.when(ahead, _area("_b")).otherwise(_area("_a")).alias("second_area"))


def _kept(block: pd.DataFrame, starts: np.ndarray, threshold: float) -> pd.DataFrame:
    x, y, w, h = (block[c].to_numpy(dtype=np.float64) for c in ("x", "y", "w", "h"))
    area, kept = (w + 1) * (h + 1), []
    for start, end in zip(starts, [*starts[1:], len(block)]):
        waiting = np.arange(start, end)
        while len(waiting):
            head, rest = waiting[0], waiting[1:]
            kept.append(head)
            across = np.minimum(x[head] + w[head], x[rest] + w[rest]) - np.maximum(x[head], x[rest]) + 1
            down = np.minimum(y[head] + h[head], y[rest] + h[rest]) - np.maximum(y[head], y[rest]) + 1
            waiting = rest[np.maximum(across, 0) * np.maximum(down, 0) / area[rest] <= threshold]
    return block.iloc[kept][BOX]


def suppress(boxes: DataFrame, threshold: float = 0.3, front: int = 20_000) -> DataFrame:
    """Greedy non-maximum suppression per image.

    Boxes are taken from the largest bottom edge upwards (ties: larger box id first); a taken box removes the later ones
    of which it covers more than ``threshold``. Of boxes at one place only the first is looked at. Boxes without a
    place are left out, boxes without an image are on one image.

    What a box becomes depends on earlier boxes alone, so the first ``front`` boxes of a group can be folded by one task and
    then remove later ones wherever these are. The first groups are the images. What is left of larger ones is grouped
    anew by connected conflicts, which do not touch each other and are folded side by side, until nothing is left.
    """
    whole = _whole(boxes)
    if threshold >= 1:
        return whole.select(*BOX)
    waiting = written(
        whole.groupBy("_image", "x", "y", "w", "h").agg(F.max("box").alias("box"), F.first("image").alias("image"))
        .select(*BOX, F.col("_image").alias("_group")), "boxes")
    place = F.struct((F.col("y") + F.col("h")).alias("bottom"), F.col("box").alias("box"))
    schema, order, kept = waiting.select(*BOX).schema, [F.desc(F.col("y") + F.col("h")), F.desc("box")], []

    def folded(rows: DataFrame) -> DataFrame:
        return map_groups(rows, "_group", order, lambda block, starts: _kept(block, starts, threshold), schema)

    while True:
        crowded = written(
            waiting.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > front).select("_group"), "crowded")
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, [*kept, folded(waiting)])
        kept.append(folded(waiting.join(crowded, "_group", "left_anti")))
        large = waiting.join(crowded, "_group", "left_semi")
        first = written(large.withColumn("_place", F.row_number().over(W.partitionBy("_group").orderBy(*order))).filter(
            F.col("_place") <= front).drop("_place"), "front")
        ends = first.groupBy("_group").agg(F.min(place).alias("_end"))
        taken = written(folded(first), "taken")
        kept.append(taken)
        rest = large.join(ends, "_group").filter(place < F.col("_end")).select(*BOX)
        waiting, free = _regrouped(written(_survivors(taken, rest, threshold), "rest"), threshold)
        kept.append(free)


def _survivors(taken: DataFrame, rest: DataFrame, threshold: float) -> DataFrame:
    """Boxes of ``rest`` of which no taken box covers more than ``threshold``."""
    beaten = meetings(taken, rest).filter(F.col("shared") / _area("_b") > threshold).select(
        F.col("_image").alias("_i"), F.col("box_b").alias("_b")).distinct()
    whole = _whole(rest)
    return whole.join(beaten, (whole["_image"] == beaten["_i"]) & (whole["box"] == beaten["_b"]), "left_anti").select(*BOX, "_image")


def _regrouped(rest: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Boxes in some conflict with their connected group, and the boxes that are in none."""
    conflicts = meetings(rest.select(*BOX)).filter(F.col("shared") / F.least(_area("_a"), _area("_b")) > threshold)
    node = lambda box: F.struct(F.col("_image").alias("image"), F.col(box).alias("box"))
    groups = written(components(conflicts.select(node("box_a").alias("a"), node("box_b").alias("b"))), "groups").select(
        F.col("node.image").alias("_image"), F.col("node.box").alias("box"), F.col("root").cast("string").alias("_group"))
    waiting = written(rest.join(groups, ["_image", "box"]).select(*BOX, "_group"), "boxes")
    return waiting, rest.join(groups, ["_image", "box"], "left_anti").select(*BOX)
