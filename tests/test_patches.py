"""The patch builder against numpy, and its files through the raster sink."""

import math

import numpy as np
from pyspark.sql import functions as F

from rasterloom.operators import patches as B
from rasterloom.sources import files as S

PIXELS = "event string, layer string, band int, row int, col int, value double"
PLACES = "event string, layer string, minx double, maxy double, res_x double, res_y double"
SCENES = "event string, minx double, miny double, maxx double, maxy double"


def layer(name, band, a, event="e"):
    return [(event, name, band, r, c, None if np.isnan(a[r, c]) else float(a[r, c])) for r in range(a.shape[0]) for c in range(a.shape[1])]


def weight(d):
    d = abs(d)
    return 1.5 * d**3 - 2.5 * d**2 + 1 if d < 1 else -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2 if d < 2 else 0.0


def cubic(a, x, y):
    if not (0 <= math.floor(y) < len(a) and 0 <= math.floor(x) < len(a[0])) or np.isnan(a[math.floor(y), math.floor(x)]):
        return 9999.0
    total = k_total = 0.0
    for r in range(len(a)):
        for c in range(len(a[0])):
            k = weight(y - 0.5 - r) * weight(x - 0.5 - c)
            if not np.isnan(a[r, c]):
                total, k_total = total + k * a[r, c], k_total + k
    return total / k_total


def test_stacks_of_two_scenes(spark):
    rng = np.random.default_rng(2)
    a, d8 = rng.normal(size=(7, 6)), rng.choice([1, 2, 4, 8, 16, 32, 64, 128, 0, 3], size=(4, 4)).astype(float)
    a[2, 3] = a[6, 0] = np.nan
    stacks = {"x": (1, [("s", 1, "cubic"), ("water", 1, "mask")]), "y": (2, [("flow_sin", 1, "nearest"), ("flow_cos", 1, "nearest"), ("none", 1, "average"), ("s", 1, "average")])}
    pixels = spark.createDataFrame(layer("s", 1, a) + layer("merit", 2, d8) + layer("s", 1, a, "f"), PIXELS)
    places = spark.createDataFrame([("e", "s", -1.0, 9.5, 1.5, 1.5), ("e", "flow_sin", 0.0, 8.0, 2.0, 2.0), ("e", "flow_cos", 0.0, 8.0, 2.0, 2.0), ("f", "s", 0.0, 8.0, 1.0, 1.0)], PLACES)
    grid = B.grids(spark.createDataFrame([("e", 0.0, 0.0, 8.0, 8.0), ("f", 0.0, 0.0, 4.5, 4.5), ("small", 0.0, 0.0, 0.5, 9.0)], SCENES), 1.0, stacks)
    assert sorted((r.event, r.file, r.h, r.w, r.step_x) for r in grid.collect()) == [("e", "x", 8, 8, 1.0), ("e", "y", 4, 4, 2.0), ("f", "x", 4, 4, 1.125), ("f", "y", 2, 2, 2.25)]
    got = {(r.event, r.file, r.slot, r.row, r.col): r.value for r in B.stacked(B.with_flow(pixels), places, grid, stacks).collect()}
    assert len(got) == 2 * 64 + 4 * 16 + 2 * 16 + 4 * 4
    for r in range(8):
        for c in range(8):
            assert math.isclose(got["e", "x", 1, r, c], cubic(a, (c + 1.5) / 1.5, (9.5 - (8 - r - 0.5)) / 1.5), abs_tol=1e-9)
            assert got["e", "x", 2, r, c] == 0.0
    angle = dict(zip((1, 2, 4, 8, 16, 32, 64, 128), range(0, 360, 45)))
    for r in range(4):
        for c in range(4):
            code = d8[r, c]
            known = (got["e", "y", 1, r, c], got["e", "y", 2, r, c])
            assert got["e", "y", 3, r, c] == 9999.0
            if code not in angle:
                assert known == (9999.0, 9999.0)
            else:
                assert math.isclose(known[0] ** 2 + known[1] ** 2, 1.0)
                same = [k for k in got if k[:3] == ("e", "y", 1) and d8[k[3], k[4]] == code]
                assert {round(got[k], 9) for k in same} == {round(known[0], 9)}


def test_patches_overlap_and_files_come_back(spark, tmp_path):
    rng = np.random.default_rng(3)
    a, wet = rng.normal(size=(20, 16)), (rng.random((20, 16)) > 0.6).astype(float)
    a[:, 9:] = np.nan
    stacks = {"input_10m": (1, [("s", 1, "nearest"), ("s", 2, "nearest")]), "input_80m": (4, [("s", 1, "average")]), "flood_mask": (1, [("flood", 1, "mask")])}
    pixels = spark.createDataFrame(layer("s", 1, a) + layer("s", 2, 2 * a) + layer("flood", 1, wet), PIXELS)
    places = spark.createDataFrame([("e", n, 0.0, 20.0, 1.0, 1.0) for n in ("s", "flood")], PLACES)
    grid = B.grids(spark.createDataFrame([("e", 0.0, 0.0, 16.0, 20.0)], SCENES), 1.0, stacks)
    cells = B.kept(B.cut_stacks(B.stacked(pixels, places, grid, stacks), grid, size=8, step=4), least=0.2)
    files = B.patch_files(cells).collect()
    # Patches of columns 8 to 15 hold one column of eight with values.
    assert sorted({r.patch_number for r in files}) == [k for k in range(12) if k % 3 < 2]
    assert {(r.file, r.bands, r.h, r.w) for r in files} == {("input_10m", 2, 8, 8), ("input_80m", 1, 2, 2), ("flood_mask", 1, 8, 8)}
    for r in files:
        kr, kc = divmod(r.patch_number, 3)
        place = (slice(4 * kr, 4 * kr + 8), slice(4 * kc, 4 * kc + 8))
        data = np.array(r.data).reshape(r.bands, r.h, r.w)
        assert (r.minx, r.maxy, r.res_x) == (4.0 * kc, 20.0 - 4 * kr, 4.0 if r.file == "input_80m" else 1.0)
        if r.file == "input_10m":
            assert np.array_equal(data, np.nan_to_num(np.stack([a[place], 2 * a[place]]), nan=9999.0))
        elif r.file == "flood_mask":
            assert np.array_equal(data[0], wet[place]) and r["mask"]
        else:
            blocks = np.nan_to_num(np.array([[np.nanmean(a[i : i + 4, j : j + 4]) if j < 9 else np.nan for j in range(4 * kc, 4 * kc + 8, 4)] for i in range(4 * kr, 4 * kr + 8, 4)]), nan=9999.0)
            assert np.allclose(data[0], blocks)
    for r in B.patch_metadata(cells, size=8).collect():
        kr, kc = divmod(r.patch_number, 3)
        assert (r.bounds_minx, r.bounds_miny, r.bounds_maxx, r.bounds_maxy) == (4.0 * kc, 12.0 - 4 * kr, 4.0 * kc + 8, 20.0 - 4 * kr)
        assert r.flood_pixels == wet[4 * kr : 4 * kr + 8, 4 * kc : 4 * kc + 8].sum()
    S.register(spark)
    out = B.patch_files(cells).select("name", "bands", "h", "w", "minx", "maxy", "res_x", "res_y", "nodata", "mask", "data")
    out.write.format("raster").mode("append").save(str(tmp_path))
    back = spark.read.format("raster").load(str(tmp_path)).where(F.col("path").endswith("patch_0004_flood_mask.tif")).collect()
    assert [x for r in back for x in r.data] == wet[4:12, 4:12].ravel().tolist()


def test_published_stacks():
    assert {n: (k, len(b)) for n, (k, b) in B.STACKS.items()} == {"input_10m": (1, 5), "input_80m": (8, 5), "input_160m": (16, 2), "input_2560m": (256, 60), "flood_mask": (1, 1)}
