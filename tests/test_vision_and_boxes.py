import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import boxes, graph, vision
from tessera.sources.readers import read_images


def brute_suppress(rows, threshold):
    kept = []
    for b in sorted(rows, key=lambda r: (r[3] + r[5], r[1]), reverse=True):
        area = (b[4] + 1) * (b[5] + 1)
        for k in kept:
            w = min(b[2] + b[4], k[2] + k[4]) - max(b[2], k[2]) + 1
            h = min(b[3] + b[5], k[3] + k[5]) - max(b[3], k[3]) + 1
            if max(w, 0) * max(h, 0) / area > threshold:
                break
        else:
            kept.append(b)
    return kept


BOX_SCHEMA = "image int, box long, x int, y int, w int, h int"


def box_rows():
    rng = np.random.default_rng(4)
    rows = [(int(i % 3 == 0), i, int(rng.integers(-50, 600)), int(rng.integers(0, 600)), int(rng.integers(5, 90)), int(rng.integers(5, 90)))
            for i in range(240)]
    return rows + [(5, 1000, 10, 10, 20, 20), (5, 1001, 10, 10, 20, 20), (6, 1002, 0, 0, 1, 1)]  # identical boxes


@pytest.mark.parametrize("front", [7, 60, 10_000])
def test_suppression_does_not_depend_on_the_front(spark, front):
    rows = box_rows()
    df = spark.createDataFrame([*rows, (None, 7, 1, 1, 5, 5), (None, 8, 1, 2, 5, 5), (0, 9, None, 1, 1, 1)], BOX_SCHEMA)
    got = {(r["image"], r["box"]) for r in boxes.suppress(df, 0.3, front).collect()}
    wanted = {k[:2] for image in {r[0] for r in rows} for k in brute_suppress([r for r in rows if r[0] == image], 0.3)}
    assert got == wanted | {(None, 8)}
    assert (5, 1001) in got and (5, 1000) not in got


def test_suppression_of_a_chain_a_pile_and_mixed_sizes(spark):
    """A chain of 1000 boxes, each covering half of the next; 600 boxes on one place; small boxes on large ones."""
    rng = np.random.default_rng(9)
    rows = [(0, i, 3 * i, 6 * i, 10, 10) for i in range(1000)]
    rows += [(1, i, 40, 40, 30, 30) for i in range(600)] + [(1, 600 + i, 40 + i % 3, 40, 30, 30) for i in range(60)]
    rows += [(2, i, int(rng.integers(0, 3000)), int(rng.integers(0, 3000)), s, s) for i in range(900) for s in [int(rng.choice([3, 40, 900]))]]
    df = spark.createDataFrame(rows, BOX_SCHEMA)
    wanted = {k[:2] for image in (0, 1, 2) for k in brute_suppress([r for r in rows if r[0] == image], 0.3)}
    for front in (300, 5000):
        assert {(r["image"], r["box"]) for r in boxes.suppress(df, 0.3, front).collect()} == wanted
    assert boxes.suppress(df.limit(0), 0.3).count() == 0 and boxes.suppress(df, 1.0).count() == len(rows)


def brute_pairs(a, b):
    for p in a:
        for q in b:
            w = min(p[2] + p[4], q[2] + q[4]) - max(p[2], q[2]) + 1
            h = min(p[3] + p[5], q[3] + q[5]) - max(p[3], q[3]) + 1
            if p[0] == q[0] and w > 0 and h > 0:
                yield p[1], q[1], w * h


@pytest.mark.parametrize("block", [3, 50, 1000])
def test_overlap_pairs_do_not_depend_on_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(boxes, "BLOCK", block)
    rows = box_rows() + [(1, 2000 + i, 100, 100, s, s + i % 3) for i, s in enumerate([0, 1, 2, 3, 7, 8, 400, 1023, 1024, 5000])]
    df = spark.createDataFrame(rows, BOX_SCHEMA)
    got = sorted((r["first"], r["second"], r["shared"]) for r in boxes.overlaps(df).collect())
    assert got == sorted(t for t in brute_pairs(rows, rows) if t[0] < t[1])
    half = df.filter("box % 2 = 0"), df.filter("box % 2 = 1")
    got = sorted((r["box_a"], r["box_b"], r["shared"]) for r in boxes.meetings(*half).collect())
    assert got == sorted(brute_pairs([r for r in rows if r[1] % 2 == 0], [r for r in rows if r[1] % 2]))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_stars_and_random_graphs(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(5000, 5000)]
    pairs += [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (260, 2))]
    rng.shuffle(pairs)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(int(a)), root(int(b))))
        parent[b] = a
    wanted = {x: root(x) for x in parent}
    found = dict(map(tuple, graph.components(spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long")).collect()))
    assert found == {x: r for x, r in wanted.items() if sum(v == r for v in wanted.values()) > 1}


def test_no_window_fits_an_image_of_its_size(spark):
    sizes = spark.createDataFrame([("a", 200, 200), ("b", 201, 233), ("c", 10, 10)], "image string, height int, width int")
    levels = vision.pyramid_levels(sizes, 1.2, 200)
    assert sorted((r["image"], r["level"]) for r in levels.collect()) == [("a", 0), ("b", 0), ("c", 0)]
    windows = vision.window_positions(levels, 200, 16).collect()
    assert sorted((r["image"], r["y"], r["x"]) for r in windows) == [("b", 0, 0), ("b", 0, 16), ("b", 0, 32)]


def test_pyramid_sizes_are_successive(spark):
    sizes = spark.createDataFrame([("a", 400, 500)], "image string, height int, width int")
    got = [(r["height"], r["width"]) for r in vision.pyramid_levels(sizes, 1.2, 200).orderBy("level").collect()]
    wanted, h, w = [(400, 500)], 400, 500
    while int(h / 1.2) >= 200 and int(w / 1.2) >= 200:
        h, w = int(h / 1.2), int(w / 1.2)
        wanted.append((h, w))
    assert got == wanted


def test_gradients_match_numpy(spark):
    raster = np.random.default_rng(0).normal(size=(4, 6))
    df = spark.createDataFrame([(1, raster.ravel().tolist())], "id int, v array<double>")
    rows = vision.gradients(df, "id", "v", 4, 6).orderBy("y", "x").collect()
    gy, gx = np.gradient(raster)
    assert np.allclose([r["gx"] for r in rows], gx.ravel()) and np.allclose([r["gy"] for r in rows], gy.ravel())
    assert all(0 <= r["orientation"] < 180 for r in rows)


def test_zero_block_stays_zero(spark):
    df = spark.createDataFrame([(1, [3.0] * 64)], "id int, v array<double>")
    block = vision.block_descriptor(vision.cell_histograms(vision.gradients(df, "id", "v", 8, 8), 4))
    assert all(r["value"] == 0 for r in block.collect())


def test_descriptor_shape_and_norm():
    window = np.random.default_rng(1).integers(0, 255, (2, 200, 200)).astype(np.uint8)
    features = vision.hog(window)
    assert features.shape == (2, 24 * 24 * 36)
    assert np.allclose(np.linalg.norm(features.reshape(2, -1, 36), axis=2), 1, atol=1e-6)
    assert np.allclose(vision.hog(window[:1]), features[:1])


def images(spark):
    rng = np.random.default_rng(9)
    rows = [(f"i{k}", 70, 90, bytearray(rng.integers(0, 255, 70 * 90).astype(np.uint8).tobytes())) for k in range(3)]
    rows.append(("small", 20, 90, bytearray(20 * 90)))
    return spark.createDataFrame(rows, "image string, height int, width int, pixels binary")


def test_random_patches_are_cut_where_they_say(spark):
    df = images(spark)
    rasters = {r["image"]: np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"]) for r in df.collect()}
    rows = vision.random_patches(df, 32, 4).collect()
    assert len(rows) == 12
    for r in rows:
        assert bytes(r["pixels"]) == rasters[r["image"]][r["y"]:r["y"] + 32, r["x"]:r["x"] + 32].tobytes()


def test_detection_visits_all_windows(spark):
    df = images(spark)
    features = vision.hog(np.zeros((1, 32, 32), np.uint8)).shape[1]
    hits = vision.detect(df, np.zeros(features), 1.0, window=32, step=16, scale=1.2)
    expected = vision.window_positions(vision.pyramid_levels(df.select("image", "height", "width"), 1.2, 32), 32, 16)
    assert hits.count() == expected.count() > 0
    assert vision.detect(df, np.zeros(features), -1.0, window=32, step=16, scale=1.2).count() == 0
    biggest = hits.orderBy(F.desc("level")).first()
    assert biggest["w"] > 32 and biggest["w"] == biggest["h"]


@pytest.mark.parametrize("window, step, cell, band", [(32, 16, 8, 10**7), (32, 5, 8, 1), (30, 7, 8, 40_000), (24, 3, 4, 40_000)])
def test_histograms_of_a_level_are_those_of_its_windows(monkeypatch, window, step, cell, band):
    monkeypatch.setattr(vision.LevelHistograms, "BAND", band)
    rng = np.random.default_rng(window)
    raster = np.where(rng.random((90, 110)) < 0.5, rng.integers(0, 255, (90, 110)), 40).astype(np.uint8)
    ys, xs = np.arange(0, 90 - window, step), np.arange(0, 110 - window, step)
    monkeypatch.setattr(vision.LevelHistograms, "CHUNK", band)
    seen = []
    for y, x, cells in vision.LevelHistograms(raster, window, cell).windows(ys, xs):
        seen += zip(y.tolist(), x.tolist())
        views = np.stack([raster[a:a + window, b:b + window] for a, b in zip(y, x)])
        assert np.allclose(vision._described(cells, 2), vision.hog(views, cell, 2), atol=1e-6)
    assert seen == [(y, x) for y in ys.tolist() for x in xs.tolist()]


def test_detection_scores_every_window_as_its_descriptor_does(spark):
    df, rng = images(spark), np.random.default_rng(4)
    size = vision.hog(np.zeros((1, 32, 32), np.uint8)).shape[1]
    weights = rng.normal(size=size)
    found = {(r["image"], r["level"], r["x"], r["y"]): r["score"] for r in vision.detect(df, weights, 0.0, 32, 16, 1.2).collect()}
    wanted = {}
    for r in df.collect():
        raster, level, full = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"]), 0, r["width"]
        while True:
            for y in range(0, raster.shape[0] - 32, 16):
                for x in range(0, raster.shape[1] - 32, 16):
                    score = float((vision.hog(raster[None, y:y + 32, x:x + 32]) @ weights)[0])
                    factor = full / raster.shape[1]
                    if score > 0:
                        wanted[r["image"], level, int(x * factor), int(y * factor)] = score
            h, w = int(raster.shape[0] / 1.2), int(raster.shape[1] / 1.2)
            if h < 32 or w < 32:
                break
            raster, level = vision.resized(raster, h, w), level + 1
    assert found.keys() == wanted.keys() and len(wanted) > 5
    assert all(found[k] == pytest.approx(v, abs=1e-6) for k, v in wanted.items())


def write_bitmap(path, height, width, colour):
    row = bytes(colour) * width
    row += b"\0" * (-len(row) % 4)
    size = 54 + len(row) * height
    header = b"BM" + struct.pack("<IHHI", size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, size - 54, 0, 0, 0, 0)
    path.write_bytes(header + row * height)


def test_image_folder(spark, tmp_path):
    write_bitmap(tmp_path / "a.bmp", 20, 20, (10, 100, 200))
    write_bitmap(tmp_path / "b.bmp", 20, 21, (0, 0, 0))
    (tmp_path / "c.bmp").write_bytes(b"no image")
    rows = read_images(spark, str(tmp_path)).collect()
    assert sorted((r["height"], r["width"]) for r in rows) == [(20, 20), (20, 21)]
    only = read_images(spark, str(tmp_path), 20, 20).collect()
    assert len(only) == 1 and set(only[0]["pixels"]) == {round(10 * 0.114 + 100 * 0.587 + 200 * 0.299)}


def test_hits_leave_a_task_together(spark, monkeypatch):
    monkeypatch.setattr(vision, "HITS", 5)
    taken = {}

    class Rows:
        schema = {"image": images(spark).schema["image"]}

        def select(self, *columns):
            return self

        def mapInPandas(self, work, schema):
            taken["work"] = work

    vision.detect(Rows(), np.zeros(vision.hog(np.zeros((1, 32, 32), np.uint8)).shape[1]), 1.0, 32, 16, 1.2)
    batch = images(spark).toPandas()
    batch["levels"] = [[{"height": h, "width": w}] for h, w in zip(batch["height"], batch["width"])]
    sizes = [len(part) for part in taken["work"](iter([batch, batch]))]
    assert sum(sizes) == 2 * 3 * 12 and len(sizes) == 6  # 12 windows at a time
    monkeypatch.setattr(vision, "HITS", 30)
    assert [len(part) for part in taken["work"](iter([batch, batch]))] == [36, 36]
