"""Grids, resampling, patches, checks and geometry against plain Python and numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import geo
from rasterloom.operators import composites as C
from rasterloom.operators import rasters as R
from rasterloom.operators import spatial as P


def frame(spark, a, event="e"):
    rows = [(event, int(r), int(c), None if np.isnan(a[r, c]) else float(a[r, c])) for r in range(a.shape[0]) for c in range(a.shape[1])]
    return spark.createDataFrame(rows, "event string, row int, col int, value double")


def test_patch_grid_order_and_gaps(spark):
    scenes = spark.createDataFrame([("a", 600, 520), ("b", 255, 900), ("c", 256, 256)], "event string, w int, h int")
    got = [tuple(r) for r in R.patch_grid(scenes).orderBy("event", "patch_number").collect()]
    assert got == [("a", 0, 0, 0), ("a", 1, 0, 256), ("a", 2, 256, 0), ("a", 3, 256, 256), ("c", 0, 0, 0)]
    assert R.patch_grid(scenes.where("event = 'c'"), 128, 64).count() == 9


def test_cut_and_pack_round_trip(spark):
    rng = np.random.default_rng(1)
    a = rng.random((20, 28))
    cells = R.cut(frame(spark, a), 1, 8, 8, 20, 28).withColumn("band", F.lit(0))
    got = {r.patch_number: np.array(r.data).reshape(8, 8) for r in R.packed(cells, ["event", "patch_number"]).collect()}
    assert set(got) == set(range(6))
    for k, p in got.items():
        assert (p == a[k // 3 * 8 : k // 3 * 8 + 8, k % 3 * 8 : k % 3 * 8 + 8]).all()
    coarse = rng.random((5, 7))
    c = R.cut(frame(spark, coarse), 4, 8, 8, 20, 28)
    assert {(r.patch_number, r.r, r.c): r.value for r in c.collect()} == {(i // 2 * 3 + j // 2, i % 2, j % 2): coarse[i, j] for i in range(4) for j in range(6)}


def test_average_and_nearest(spark):
    rng = np.random.default_rng(2)
    a = rng.random((10, 10))
    a[2, 3] = np.nan
    got = {(r.row, r.col): r.value for r in R.average(frame(spark, a), 2.5, 2.5).collect()}
    w = np.array([[max(0.0, min(i + 1, (t + 1) * 2.5) - max(i, t * 2.5)) for i in range(10)] for t in range(4)])
    there = ~np.isnan(a)
    want = (w @ np.nan_to_num(a) @ w.T) / (w @ there @ w.T)
    assert all(math.isclose(got[i, j], want[i, j]) for i in range(4) for j in range(4))
    targets = spark.createDataFrame([("e", r, c) for r in range(4) for c in range(4)], "event string, row int, col int")
    near = {(r.row, r.col): r.value for r in R.nearest(frame(spark, a), targets, 2.5, 2.5).collect()}
    assert near[1, 1] == (None if np.isnan(a[3, 3]) else a[3, 3]) and near[0, 0] == a[1, 1] and near[3, 3] == a[8, 8]


def test_cubic_reproduces_quadratics_and_respects_gaps(spark):
    n, halo, out = 8, 2, 4
    y, x = np.mgrid[-halo : n + halo, -halo : n + halo]
    f = lambda y, x: 3 + 0.5 * x - y + 0.1 * x * y + 0.05 * x * x
    a = f(y, x).astype(float)
    b = a.copy()
    b[halo + 1, halo + 1] = np.nan
    df = spark.createDataFrame([("e", 1, n, halo, a.ravel().tolist()), ("e", 2, n, halo, b.ravel().tolist())], "event string, tile long, size int, halo int, data array<double>")
    got = {r.tile: np.array(r.data, float).reshape(out, out) for r in R.cubic(df, out).collect()}
    at = (np.arange(out) + 0.5) * 2 - 0.5
    assert np.allclose(got[1], f(at[:, None], at[None, :]))
    assert np.isnan(got[2][0, 0]) and np.isfinite(got[2]).sum() == out * out - 1


def test_mosaic_takes_the_first_value(spark):
    df = spark.createDataFrame([("e", 1, 0, 0, None), ("e", 2, 0, 0, 5.0), ("e", 3, 0, 0, 7.0), ("e", 1, 0, 1, None)], "event string, ord int, row int, col int, value double")
    assert {(r.row, r.col): r.value for r in R.mosaic(df).collect()} == {(0, 0): 5.0, (0, 1): None}


def test_five_checks_and_repair(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("e", 0, "input_160m", 2, 16, 16, [1.0]), ("e", 1, "input_160m", 1, 16, 15, [nan, inf]), ("e", 2, "flood_mask", 1, 256, 256, [0.0, 1.0, 2.0, nan]), ("e", 3, "input_10m", 5, 256, 256, None)]
    files = spark.createDataFrame(rows, "event string, patch int, file string, bands int, h int, w int, data array<double>")
    got = sorted((r.patch, r.check) for r in R.quality_issues(files).collect())
    assert got == [(1, "band_count"), (1, "nan_inf"), (1, "shape"), (2, "mask_not_binary"), (2, "nan_inf"), (3, "missing")]
    fixed = files.where("patch IN (1, 2)").select("patch", R.repaired(F.col("data"), F.col("file") == "flood_mask").alias("d"))
    assert {r.patch: r.d for r in fixed.collect()} == {1: [9999.0, 9999.0], 2: [0.0, 1.0, 2.0, 0.0]}


def test_areas_shrink_to_the_poles(spark):
    rows = [("eq", r, 1 if r < 2 else 0, 0.01, 0.01, 0.02) for r in range(4)] + [("n", r, 0, 0.01, 0.01, 60.02) for r in range(4)]
    got = {r.event: r for r in R.mask_areas(spark.createDataFrame(rows, "event string, row int, value int, res_x double, res_y double, top double")).collect()}
    assert got["eq"].flooded_area_km2 == pytest.approx(got["eq"].aoi_area_km2 / 2, abs=0.02)
    assert got["n"].aoi_area_km2 == pytest.approx(got["eq"].aoi_area_km2 / 2, rel=0.01) and got["n"].flooded_area_km2 == 0


def square(x, y, n):
    return [(x, y), (x + n, y), (x + n, y + n), (x, y + n)]


def test_points_holes_and_nearest(spark):
    polys = spark.createDataFrame([(1, [square(0.0, 0.0, 10.0), square(4.0, 4.0, 2.0)]), (2, [square(20.0, 0.0, 5.0)]), (3, [])], f"poly_id long, rings {geo.RINGS}")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 19.51, 1.0), (4, 19.4, 1.0), (5, 22.0, 2.0)], "pid long, x double, y double")
    assert {r.pid: r.poly_id for r in P.within(pts, polys).collect()} == {1: 1, 5: 2}
    assert {r.pid: r.poly_id for r in P.basin(pts, polys).collect()} == {1: 1, 5: 2, 3: 2}
    far = spark.createDataFrame([(9, 500.0, 500.0), (8, 12.0, 0.5)], "pid long, x double, y double")
    got = {r.pid: (r.poly_id, round(r.dist, 6)) for r in P.nearest_any(far, polys, 0.5, 10.0).collect()}
    assert got == {9: (2, round(math.hypot(475, 495), 6)), 8: (1, 2.0)}
    assert P.nearest_any(far, polys.where("poly_id > 5"), 0.5, 10.0).count() == 0


def test_rasterized_equals_ray_casting(spark):
    rng = random.Random(4)
    ring = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(7)]
    polys = spark.createDataFrame([("a", [ring, square(2.0, 2.0, 3.0)])], f"event string, rings {geo.RINGS}")
    grid = spark.createDataFrame([("a", 25, 25, 0.0, 10.0, 0.4)], "event string, w int, h int, minx double, maxy double, res double")
    got = {(r.row, r.col) for r in P.rasterized(polys, grid).collect()}

    def odd(x, y):
        n = 0
        for r in (ring, square(2.0, 2.0, 3.0)):
            for (ax, ay), (bx, by) in zip(r, [*r[1:], r[0]]):
                if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                    n += 1
        return n % 2

    assert got == {(r, c) for r in range(25) for c in range(25) if odd((c + 0.5) * 0.4, 10 - (r + 0.5) * 0.4)}


def test_centroid_bounds_and_projection(spark):
    df = spark.createDataFrame([(1, [square(1.0, 2.0, 4.0)])], f"k int, rings {geo.RINGS}").withColumn("s", geo.edges(F.col("rings")))
    r = df.select(geo.centroid(F.col("s")).alias("c"), geo.bounds(F.col("s")).alias("b")).first()
    assert (r.c.x, r.c.y, r.c.area) == pytest.approx((3.0, 4.0, 16.0)) and tuple(r.b) == (1.0, 2.0, 5.0, 6.0)
    # Published example: 43°38'33.24" N, 79°23'13.7" W is 630084 E, 4833439 N in zone 17.
    x = spark.sql("SELECT -79.387139D AS lon, 43.642567D AS lat").select(geo.utm(F.col("lon"), F.col("lat"), geo.utm_zone(F.col("lon"))).alias("u"), geo.utm_zone(F.col("lon")).alias("z")).first()
    assert x.z == 17 and x.u.x == pytest.approx(630084, abs=1) and x.u.y == pytest.approx(4833439, abs=1)


def test_grid_snap_and_flow(spark):
    r = spark.range(1).select(geo.grid(F.lit(0.0), F.lit(0.0), F.lit(105.0), F.lit(99.0), 10).alias("g"), geo.snapped(F.lit(-0.15), F.lit(0.05), F.lit(0.21), F.lit(0.3), F.lit(0.1)).alias("s"), geo.flow(F.lit(4)).alias("f"), geo.flow(F.lit(3)).alias("n")).first()
    assert (r.g.w, r.g.h, r.g.transform.a, r.g.transform.e) == (10, 9, 10.5, -11.0)
    assert (r.s.minx, r.s.miny, r.s.maxx) == pytest.approx((-0.2, 0.0, 0.3))
    assert (r.f.sin, r.f.cos) == pytest.approx((1.0, 0.0), abs=1e-9) and (r.n.sin, r.n.cos) == (9999.0, 9999.0)


def test_windows_widen_until_enough_is_covered(spark):
    day = lambda k: f"2020-01-{31 - k:02d} 10:00:00"  # noqa: E731  k days before February 1, less one
    rows = [(1, day(1), 1.0), (1, day(2), 3.0), (1, day(20), 50.0), (2, day(20), 7.0), (3, "2020-02-01 00:00:00", 9.0)]
    obs = spark.createDataFrame(rows, "pixel long, t string, value double").withColumn("ts", F.to_timestamp("t"))
    pixels = spark.createDataFrame([(1, 1.0), (2, 1.0)], "pixel long, area double")
    event = F.to_date(F.lit("2020-02-01"))
    got = {r.pixel: (r.value, r.stage, r.coverage, r.ok) for r in C.widening(obs, pixels, event, ["value"]).collect()}
    assert got == {1: (2.0, 30, 100.0, True), 2: (7.0, 30, 100.0, True)}
    more = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0)], "pixel long, area double")
    got = {r.pixel: (r.value, r.stage, r.coverage, r.ok) for r in C.widening(obs, more, event, ["value"]).collect()}
    assert got == {1: (2.0, 60, 50.0, False), 2: (7.0, 60, 50.0, False), 3: (None, 60, 50.0, False)}


def test_clouds_relax_then_another_season(spark):
    rows = [(1, "2020-01-20 00:00:00", 45, 1.0), (2, "2021-01-25 00:00:00", 10, 5.0), (1, "2021-01-25 00:00:00", 10, 6.0)]
    obs = spark.createDataFrame(rows, "pixel long, t string, cloud_pct int, value double").withColumn("ts", F.to_timestamp("t"))
    pixels = spark.createDataFrame([(1, 1.0), (2, 1.0)], "pixel long, area double")
    event = F.to_date(F.lit("2020-02-01"))
    got = {r.pixel: (r.value, r.ok, r.uses_future) for r in C.relaxing(obs, pixels, event, ["value"]).collect()}
    assert got == {1: (1.0, True, True), 2: (5.0, True, True)}
    got = {r.pixel: (r.value, r.ok, r.uses_future) for r in C.relaxing(obs, pixels, event, ["value"], seasonal=False).collect()}
    assert got == {1: (1.0, False, False), 2: (None, False, False)}


def test_series_leave_the_event_out(spark):
    rows = [(1, "2020-01-31 01:00:00", 2.0), (1, "2020-01-31 02:00:00", 4.0), (1, "2020-02-01 00:00:00", 100.0), (1, "2020-01-29 05:00:00", 1.0)]
    obs = spark.createDataFrame(rows, "pixel long, t string, value double").withColumn("ts", F.to_timestamp("t"))
    pixels = spark.createDataFrame([(1,), (2,)], "pixel long")
    event = F.to_date(F.lit("2020-02-01"))
    assert {r.pixel: r.series for r in C.rain(obs, pixels, event, 3).collect()} == {1: [0.5, 9999.0, 3.0], 2: [9999.0] * 3}
    assert {r.pixel: r.series for r in C.moisture(obs, pixels, event, 3).collect()}[1] == [1.0, 9999.0, 2.0]


def test_composites_of_many_events_are_those_of_each(spark):
    from rasterloom.operators import composites as C

    rng = np.random.default_rng(11)
    days = {"A": "2024-03-10", "B": "2024-02-20", "C": "2023-06-01"}
    rows = [(e, int(p), f"202{int(y)}-0{int(m)}-{int(d):02d} 05:00:00", int(c), float(v)) for e in days for p, y, m, d, c, v in zip(rng.integers(0, 12, 90), rng.integers(2, 5, 90), rng.integers(1, 7, 90), rng.integers(1, 29, 90), rng.integers(0, 100, 90), rng.random(90))]
    obs = spark.createDataFrame(rows, "event string, pixel int, ts string, cloud_pct int, value double").withColumn("ts", F.to_timestamp("ts"))
    pixels = spark.createDataFrame([(e, p, 1.0 + p % 3) for e in days for p in range(14)], "event string, pixel int, area double")
    events = spark.createDataFrame(list(days.items()), "event string, day string").withColumn("day", F.to_date("day"))
    for run in (
        lambda o, p, e: C.widening(o, p, e, ["value"], (5, 20, 60), 60.0),
        lambda o, p, e: C.relaxing(o, p, e, ["value"], (30, 60, 100), 30, 80.0),
        lambda o, p, e: C.relaxing(o, p, e, ["value"], (30, 60, 100), 30, 80.0, seasonal=False),
        lambda o, p, e: C.rain(o, p, e, 20),
    ):
        got = sorted(map(tuple, run(obs, pixels, events).collect()), key=str)
        want = [(e, *r) for e, d in days.items() for r in run(obs.where(F.col("event") == e).drop("event"), pixels.where(F.col("event") == e).drop("event"), F.to_date(F.lit(d))).collect()]
        assert str(got) == str(sorted(want, key=str))
