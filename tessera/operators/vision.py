"""Image windows: gradients, orientation histograms, descriptors, pyramids and detection.

Images are rows ``image, height, width, pixels`` (one byte per pixel). One image or one
pyramid level is the unit of work inside a task; images spread over all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BINS = 9
HITS = 10_000  # found windows that a task holds before it hands them on


def gradients(df: DataFrame, image: str, values: str, height: int, width: int) -> DataFrame:
    """Per-pixel gradient, magnitude and unsigned orientation of images stored as flat arrays.

    Central differences inside, one-sided ones at the edges. The neighbours come from the
    image's own array, so nothing is shuffled.
    """
    v, at = F.col("_v"), F.col("_i")
    x, y = at % width, F.floor(at / width).cast("int")

    def slope(position: Column, last: int, stride: int) -> Column:
        before = F.when(position == 0, at).otherwise(at - stride)
        after = F.when(position == last, at).otherwise(at + stride)
        span = F.when((position == 0) | (position == last), F.lit(1.0)).otherwise(F.lit(2.0))
        return (F.get(v, after) - F.get(v, before)) / span

    spread = df.select(
        F.col(image).alias("image"), F.col(values).cast("array<double>").alias("_v"),
        F.explode(F.sequence(F.lit(0), F.lit(height * width - 1))).alias("_i"))
    slopes = spread.select("image", y.alias("y"), x.cast("int").alias("x"),
                           slope(x, width - 1, 1).alias("gx"), slope(y, height - 1, width).alias("gy"))
    angle = (F.degrees(F.atan2("gy", "gx")) + 180.0) % 180.0
    return slopes.select("*", F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")).alias("magnitude"),
                         angle.alias("orientation"))


def cell_histograms(pixels: DataFrame, cell: int) -> DataFrame:
    """Magnitude per cell and 20-degree orientation bin."""
    number = F.least(F.floor(F.col("orientation") / 20.0), F.lit(BINS - 1)).cast("int")
    return pixels.groupBy(
        "image", F.floor(F.col("y") / cell).cast("int").alias("cell_y"), F.floor(F.col("x") / cell).cast("int").alias("cell_x"),
        number.alias("bin")).agg(F.sum("magnitude").alias("weight"))


def block_descriptor(histograms: DataFrame) -> DataFrame:
    """Histogram weights of an image divided by their common length; a zero block stays as it is."""
    lengths = histograms.groupBy(F.col("image").alias("_image")).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_length"))
    joined = histograms.join(lengths, histograms["image"] == lengths["_image"])
    value = F.when(F.col("_length") == 0, F.col("weight")).otherwise(F.col("weight") / F.col("_length"))
    return joined.select("image", "cell_y", "cell_x", "bin", value.alias("value"))


def hog(windows: np.ndarray, cell: int = 8, block: int = 2) -> np.ndarray:
    """Descriptors of equally large windows (count, height, width), one row each.

    Cell histograms are gathered in overlapping blocks, which are scaled to unit length,
    clipped and scaled again.
    """
    g = windows.astype(np.float32)
    gx, gy = np.zeros_like(g), np.zeros_like(g)
    gx[:, :, 1:-1] = g[:, :, 2:] - g[:, :, :-2]
    gy[:, 1:-1, :] = g[:, 2:, :] - g[:, :-2, :]
    count, rows, columns = len(g), g.shape[1] // cell, g.shape[2] // cell
    used = (slice(None), slice(0, rows * cell), slice(0, columns * cell))
    gx, gy = gx[used], gy[used]
    number = (np.rad2deg(np.arctan2(gy, gx)) % 180.0 // (180.0 / BINS)).astype(np.int64)
    np.minimum(number, BINS - 1, out=number)
    place = (np.arange(rows * cell) // cell)[:, None] * columns + (np.arange(columns * cell) // cell)[None, :]
    number += (np.arange(count) * rows * columns)[:, None, None] * BINS + place[None] * BINS
    size = count * rows * columns * BINS
    cells = np.bincount(number.ravel(), np.hypot(gx, gy).ravel(), size).reshape(count, rows, columns, BINS) / cell**2
    return _described(cells, block)


def _described(cells: np.ndarray, block: int) -> np.ndarray:
    """Blocks of cell histograms (count, rows, columns, bins), scaled, clipped and scaled again; one row each."""
    count, rows, columns, _ = cells.shape
    down, across = rows - block + 1, columns - block + 1
    if down <= 0 or across <= 0:
        return np.zeros((count, 0))
    blocks = np.stack([cells[:, i:i + down, j:j + across] for i in range(block) for j in range(block)], axis=3)
    blocks = blocks.reshape(count, down, across, -1)

    def unit(b):
        return b / np.sqrt((b**2).sum(axis=3, keepdims=True) + 1e-10)

    return unit(np.minimum(unit(blocks), 0.2)).reshape(count, -1)


class LevelHistograms:
    """Cell histograms of all windows of one pyramid level, from running sums of each orientation over the level.

    A pixel's gradient and orientation are worked out once, however many windows it is in. Inside a window they are those of
    the level. On its outermost lines a window knows one neighbour only, so the gradient across the line is 0 there: what
    is left along a column falls into the middle orientation, along a row into the first, and corners have none.
    Running sums are kept for one band of rows at a time, of about ``BAND`` numbers.
    """

    BAND, CHUNK = 16_000_000, 2_000_000

    def __init__(self, raster: np.ndarray, window: int, cell: int):
        self.window, self.cell = window, cell
        g = raster.astype(np.float32)
        self.gx, self.gy = np.zeros_like(g), np.zeros_like(g)
        self.gx[:, 1:-1] = g[:, 2:] - g[:, :-2]
        self.gy[1:-1, :] = g[2:, :] - g[:-2, :]
        self.number = np.minimum(np.rad2deg(np.arctan2(self.gy, self.gx)) % 180.0 // (180.0 / BINS), BINS - 1).astype(np.int64)
        self.size = np.hypot(self.gx, self.gy)

    def windows(self, ys: np.ndarray, xs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(y, x, cells)`` of all windows, some at a time: corners and histograms (window, row, column, bin)."""
        width = self.size.shape[1]
        room = max(self.BAND // ((BINS + 2) * (width + 1)), self.window)
        some = max(self.CHUNK // (BINS * (self.window // self.cell + 1) ** 2), 1)
        start = 0
        while start < len(ys):
            stop = int(np.searchsorted(ys, ys[start] + room - self.window, "right"))
            sums = self._sums(int(ys[start]), int(ys[stop - 1]) + self.window)
            y, x = (a.ravel() for a in np.meshgrid(ys[start:stop], xs, indexing="ij"))
            for at in range(0, len(y), some):
                here = slice(at, at + some)
                yield y[here], x[here], self._cells(sums, y[here] - int(ys[start]), x[here])
            start = stop

    def _sums(self, top: int, bottom: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Running sums over a band: per orientation from its corner, along rows, and down columns."""
        band, height, width = slice(top, bottom), bottom - top, self.size.shape[1]
        corner = np.zeros((BINS, height + 1, width + 1))
        place = np.arange(1, height + 1)[:, None] * (width + 1) + np.arange(1, width + 1)
        corner.ravel()[self.number[band] * ((height + 1) * (width + 1)) + place] = self.size[band]
        np.cumsum(corner, axis=1, out=corner)
        np.cumsum(corner, axis=2, out=corner)
        along, down = np.zeros((height, width + 1)), np.zeros((height + 1, width))
        np.cumsum(np.abs(self.gx[band]), axis=1, dtype=np.float64, out=along[:, 1:])
        np.cumsum(np.abs(self.gy[band]), axis=0, dtype=np.float64, out=down[1:])
        return corner, along, down

    def _cells(self, sums: tuple[np.ndarray, np.ndarray, np.ndarray], y: np.ndarray, x: np.ndarray) -> np.ndarray:
        corner, along, down = sums
        cell, last, n = self.cell, self.window - 1, self.window // self.cell
        inner = np.clip(np.arange(n + 1) * cell, 1, last)  # without the outermost lines
        r, c = y[:, None] + inner, x[:, None] + inner
        found = np.diff(np.diff(corner[:, r[:, :, None], c[:, None, :]], axis=2), axis=3)
        cells = np.ascontiguousarray(found.transpose(1, 2, 3, 0))
        for line in {0, last}:
            if line // cell < n:  # else the window is not a whole number of cells
                cells[:, line // cell, :, 0] += np.diff(along[(y + line)[:, None], c], axis=1)
                cells[:, :, line // cell, BINS // 2] += np.diff(down[r, (x + line)[:, None]], axis=1)
        return cells / cell**2


def _raster(row) -> np.ndarray:
    return np.frombuffer(row.pixels, dtype=np.uint8).reshape(row.height, row.width)


def descriptors(images: DataFrame, cell: int = 8, block: int = 2) -> DataFrame:
    """``image, features`` of whole images."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "image": batch["image"],
                "features": [hog(_raster(r)[None], cell, block)[0] for r in batch.itertuples(index=False)]})

    kind = images.schema["image"].dataType.simpleString()
    return images.select("image", "height", "width", "pixels").mapInPandas(work, f"image {kind}, features array<double>")


def level_path(scale: float, window: int) -> Column:
    """Array of (level, height, width) made from the columns ``height`` and ``width``."""
    def reduced(side: Column) -> Column:
        return F.floor(side / F.lit(scale)).cast("int")

    start = F.struct(F.lit(0).alias("level"), F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"))
    most = F.ceil(F.log(F.greatest("height", "width").cast("double") + 1) / math.log(scale)).cast("int") + 1

    def grow(levels: Column, i: Column) -> Column:
        last = F.element_at(levels, -1)
        height, width = reduced(last["height"]), reduced(last["width"])
        fits = (last["level"] == i - 1) & (height >= window) & (width >= window)
        added = F.array(F.struct(i.alias("level"), height.alias("height"), width.alias("width")))
        return F.when(fits, F.concat(levels, added)).otherwise(levels)

    return F.aggregate(F.sequence(F.lit(1), most), F.array(start), grow)


def pyramid_levels(df: DataFrame, scale: float, window: int) -> DataFrame:
    """Sizes of the successive reductions of each image, down to the last that holds the window.

    The image itself is level 0 whatever its size. ``df`` has columns image, height, width.
    """
    return df.select("image", F.col("width").alias("_full"), F.inline(level_path(scale, window))).select(
        "image", "level", "height", "width", (F.col("_full") / F.col("width")).alias("scale_factor"))


def window_positions(levels: DataFrame, window: int, step: int) -> DataFrame:
    """Top-left corners of the windows; the last possible position is not visited."""
    fits = levels.filter((F.col("height") > window) & (F.col("width") > window))
    return (
        fits.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("height") - window - 1, F.lit(step))))
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("width") - window - 1, F.lit(step))))
    )


def resized(raster: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear reduction with pixel centres aligned."""
    def places(size, new):
        p = np.clip((np.arange(new) + 0.5) * size / new - 0.5, 0, size - 1)
        low = np.floor(p).astype(int)
        return low, np.minimum(low + 1, size - 1), p - low

    r0, r1, fr = places(raster.shape[0], height)
    c0, c1, fc = places(raster.shape[1], width)
    g = raster.astype(np.float64)
    top = g[r0][:, c0] * (1 - fc) + g[r0][:, c1] * fc
    bottom = g[r1][:, c0] * (1 - fc) + g[r1][:, c1] * fc
    return np.rint(top * (1 - fr[:, None]) + bottom * fr[:, None]).astype(np.uint8)


def detect(
    images: DataFrame, coefficients: np.ndarray, intercept: float, window: int = 200, step: int = 16,
    scale: float = 1.2, cell: int = 8, block: int = 2,
) -> DataFrame:
    """Windows with a positive score, as boxes in the coordinates of the full image.

    A task walks an image's levels one after the other, each made from the last, and each level's pixels once: windows
    take their histograms from running sums (``LevelHistograms``). Only the hits leave the task, ``HITS`` or more at a time.
    """
    rows = images.select("image", "height", "width", "pixels", F.transform(
        level_path(scale, window), lambda s: F.struct(s["height"].alias("height"), s["width"].alias("width"))).alias("levels"))
    weights, offset = np.asarray(coefficients, dtype=np.float64), float(intercept)

    def found(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for row in batch.itertuples(index=False):
            raster = _raster(row)
            for level, size in enumerate(row.levels):
                if level:
                    raster = resized(raster, int(size["height"]), int(size["width"]))
                factor = row.width / raster.shape[1]
                ys = np.arange(0, raster.shape[0] - window, step)
                xs = np.arange(0, raster.shape[1] - window, step)
                if not len(ys) or not len(xs):
                    continue
                for y, x, cells in LevelHistograms(raster, window, cell).windows(ys, xs):
                    score = _described(cells, block) @ weights + offset
                    hit = score > 0
                    if hit.any():
                        yield pd.DataFrame({
                            "image": row.image, "level": level, "x": (x[hit] * factor).astype(int),
                            "y": (y[hit] * factor).astype(int), "w": int(window * factor), "h": int(window * factor),
                            "score": score[hit]})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, count = [], 0
            for hits in found(batch):
                held.append(hits)
                count += len(hits)
                if count >= HITS:
                    yield pd.concat(held, ignore_index=True)
                    held, count = [], 0
            if held:
                yield pd.concat(held, ignore_index=True)

    kind = images.schema["image"].dataType.simpleString()
    return rows.mapInPandas(work, f"image {kind}, level int, x int, y int, w int, h int, score double")


def patch_positions(images: DataFrame, window: int, per_image: int, seed: int = 42) -> DataFrame:
    """Seeded random window corners; images smaller than the window are skipped."""
    def place(axis: str, room: Column) -> Column:
        drawn = F.md5(F.concat_ws("|", F.col("image").cast("string"), F.col("patch").cast("string"), F.lit(str(seed)), F.lit(axis)))
        return (F.conv(F.substring(drawn, 1, 12), 16, 10).cast("long") % (room - window + 1)).cast("int")

    fits = images.filter((F.col("height") >= window) & (F.col("width") >= window))
    return fits.withColumn("patch", F.explode(F.sequence(F.lit(1), F.lit(per_image)))).withColumns(
        {"x": place("x", F.col("width")), "y": place("y", F.col("height"))})


def random_patches(images: DataFrame, window: int, per_image: int, seed: int = 42) -> DataFrame:
    """Cropped patches ``image, patch, x, y, height, width, pixels``, put together from pieces of the image's rows."""
    first = F.col("y") * F.col("width") + F.col("x") + 1
    rows = [F.substring("pixels", first + i * F.col("width"), F.lit(window)) for i in range(window)]
    side = F.lit(window)
    return patch_positions(images, window, per_image, seed).select(
        "image", "patch", "x", "y", side.alias("height"), side.alias("width"), F.concat(*rows).alias("pixels"))
