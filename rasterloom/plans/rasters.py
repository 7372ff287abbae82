"""Queries about composites, series, grids, patches, resampling and geometry."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from rasterloom.functions import geo
from rasterloom.operators import composites as C
from rasterloom.operators import patches as B
from rasterloom.operators import rasters as R
from rasterloom.operators import spatial as P
from rasterloom.plans import standins as T


def _day():
    return F.to_date(F.lit(T.EVENT_DAY))


def _rounded(df, *names):
    return df.select(*(F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns))


def median(spark, d):
    x = C.radar(T.acquisitions(spark, d)).groupBy("pixel").agg(F.median("value").alias("value"))
    return _rounded(x, "value")


def widening(spark, d):
    out = C.widening(C.radar(T.acquisitions(spark, d)), T.pixels(spark, d), _day(), ["value"], (1, 2, 5, 15), 90.0)
    return _rounded(out, "value", "coverage")


def widening_events(spark, d):
    obs, pixels = (T.of_each_event(x) for x in (C.radar(T.acquisitions(spark, d)), T.pixels(spark, d)))
    return _rounded(C.widening(obs, pixels, T.event_days(spark), ["value"], (1, 2, 5, 15), 90.0), "value", "coverage")


def relaxing_events(spark, d):
    obs, pixels = (T.of_each_event(x) for x in (T.acquisitions(spark, d), T.pixels(spark, d)))
    return _rounded(C.relaxing(obs, pixels, T.event_days(spark), ["value"], (3, 6, 12, 40), 8, 95.0, seasonal=False), "value", "coverage")


def rain_events(spark, d):
    x = C.rain(T.of_each_event(T.acquisitions(spark, d)), T.of_each_event(T.pixels(spark, d)), T.event_days(spark), 12)
    return x.select("event", "pixel", F.posexplode("series").alias("k", "v")).select("event", "pixel", "k", F.round("v", 6).alias("v"))


def relaxing(spark, d):
    out = C.relaxing(T.acquisitions(spark, d), T.pixels(spark, d), _day(), ["value"], (3, 6, 12, 40), 8, 95.0, seasonal=False)
    return _rounded(out, "value", "coverage")


def indices(spark, d):
    x = T.acquisitions(spark, d).groupBy("pixel").agg(F.median(F.when(F.col("mode") == "IW", F.col("value"))).alias("a"), F.median(F.when(F.col("cloud_pct") < 50, F.col("value"))).alias("b"))
    return x.select("pixel", F.round(C.normalised_difference(F.col("a"), F.col("b")), 6).alias("nd"), F.round(C.gap_filled(F.col("a"), F.col("b")), 6).alias("filled"))


def covered(spark, d):
    x = T.acquisitions(spark, d).where("cloud_pct < 2").groupBy("pixel").agg(F.max("value").alias("v"))
    return T.pixels(spark, d).join(x, "pixel", "left").agg(F.round(C.coverage(F.col("v").isNotNull(), F.col("area")), 6).alias("pct"))


def _series(df):
    return df.select("pixel", F.posexplode("series").alias("k", "v")).select("pixel", "k", F.round("v", 6).alias("v"))


def daily_rain(spark, d):
    return _series(C.rain(T.acquisitions(spark, d), T.pixels(spark, d), _day(), 12))


def daily_moisture(spark, d):
    return _series(C.moisture(T.acquisitions(spark, d), T.pixels(spark, d), _day(), 12))


def water(spark, d):
    return T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), C.open_water(F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderkey") % 4 * 40)).cast("int").alias("water"))


def _box(spark, d):
    return T.points(spark, d).select("pid", "x", "y", (F.col("x") + 1.37).alias("x2"), (F.col("y") + 0.83).alias("y2"))


def snap(spark, d):
    s = geo.snapped(F.col("x"), F.col("y"), F.col("x2"), F.col("y2"), F.lit(0.1))
    return _box(spark, d).select("pid", s.alias("s")).select("pid", *(F.round(f"s.{c}", 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")), F.round(F.element_at("s.transform", 6), 6).alias("origin_y"))


def buffer(spark, d):
    s = geo.buffered(F.col("x"), F.col("y"), F.col("x2"), F.col("y2"))
    return _box(spark, d).select("pid", s.alias("s")).select("pid", *(F.round(f"s.{c}", 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")))


def grids(spark, d):
    g = geo.grid(F.col("x"), F.col("y"), F.col("x2"), F.col("y2"), 0.25)
    b = geo.patch_bounds(F.col("g.transform"), F.lit(1), F.lit(1), 2)
    x = _box(spark, d).select("pid", g.alias("g"))
    return x.select("pid", "g.w", "g.h", F.round("g.transform.a", 6).alias("a"), F.round("g.transform.e", 6).alias("e"), b.alias("b")).select("pid", "w", "h", "a", "e", F.round("b.minx", 6).alias("minx"), F.round("b.maxy", 6).alias("maxy"), F.round("b.miny", 6).alias("miny"))


def directions(spark, d):
    code = F.element_at(F.array(*map(F.lit, (1, 2, 4, 8, 16, 32, 64, 128, 3, 0))), (F.col("o_orderkey") % 10 + 1).cast("int"))
    x = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), geo.flow(code).alias("f"))
    return x.select("id", (F.round("f.sin", 6) + 0.0).alias("s"), (F.round("f.cos", 6) + 0.0).alias("c"))


def patch_grid(spark, d):
    scenes = T.table(spark, d, "customer").select(F.col("c_custkey").alias("event"), (F.col("c_custkey") * 13 % 900).alias("w"), (F.col("c_custkey") * 7 % 800).alias("h"))
    return R.patch_grid(scenes)


def patch_cut(spark, d):
    """8 x 8 fine pixels to a patch, coarse pixels four wide."""
    fine = R.cut(T.raster(spark, d), 1, 8, 8, 64, 64).groupBy("event", "patch_number").agg(F.count("value").alias("n"), F.round(R.valid_ratio(F.col("value")), 6).alias("valid"))
    coarse = T.raster(spark, d).where("row < 16 AND col < 16")
    c = R.cut(coarse, 4, 8, 8, 64, 64).groupBy("event", "patch_number").agg(F.count("*").alias("coarse"))
    return fine.join(c, ["event", "patch_number"], "left")


#: Stacks over a small scene: pixels 1 and 8 wide, patches of 32 every 16.
SMALL = {"fine": (1, [("a", 1, "cubic"), ("b", 1, "mask"), ("c", 1, "nearest")]), "coarse": (8, [("c", 1, "average"), ("none", 1, "cubic")]), "flood_mask": (1, [("b", 1, "mask")])}
_PLACES = [("a", -3.25, 70.125, 2.0, 2.0), ("b", 0.5, 63.25, 1.0, 1.0), ("c", -1.75, 66.5, 1.625, 1.625)]


def patch_stack(spark, d):
    """Three layers of a scene, each on a grid of its own, stacked and cut in overlapping patches."""
    x = T.raster(spark, d)
    layers = F.explode(F.array(*map(F.lit, "abc")))
    value = F.when(F.col("layer") == "b", F.when(F.col("value") > 50000, 1.0).otherwise(0.0)).otherwise(F.col("value").cast("double"))
    pixels = x.withColumn("layer", layers).withColumn("band", F.lit(1)).withColumn("value", value)
    scenes = x.select("event").distinct().select("event", F.lit(0.0).alias("minx"), F.lit(0.0).alias("miny"), F.lit(64.0).alias("maxx"), F.lit(64.0).alias("maxy"))
    places = scenes.select("event", F.explode(F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(p, ("layer", "minx", "maxy", "res_x", "res_y")))) for p in _PLACES))).alias("p")).select("event", "p.*")
    grid = B.grids(scenes, 1.0, SMALL)
    cells = B.kept(B.cut_stacks(B.stacked(pixels, places, grid, SMALL), grid, "fine", 32, 16), "fine", 0.6)
    there = F.when(F.col("value") != B.DEFAULTS.nodata, F.col("value"))
    out = cells.groupBy("event", "patch_number", "file", "slot").agg(F.count("*").alias("n"), F.count(there).alias("valid"), F.round(F.avg(there), 3).alias("mean"), F.round(F.avg(there * (F.col("r") + 2 * F.col("c"))), 2).alias("placed"))
    return out.join(B.patch_metadata(cells, "flood_mask", 32), ["event", "patch_number"])


def valid_patches(spark, d):
    x = R.cut(T.raster(spark, d), 1, 8, 8, 64, 64).groupBy("event", "patch_number").agg(R.valid_ratio(F.col("value")).alias("v"))
    return x.where("v >= 0.9").select("event", "patch_number")


def flood_pixels(spark, d):
    p = T.patches(spark, d)
    return p.groupBy("folder_name").agg(F.sum("flood_pixels").alias("flood_pixels"), F.round(F.max(F.col("flood_pixels") / 65536), 6).alias("most"))


def quality(spark, d):
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 2 == 0, "input_160m").otherwise("flood_mask")
    data = F.when(k % 9 == 0, None).when(k % 7 == 0, F.array(F.lit(float("nan")), F.lit(1.0))).when(k % 5 == 0, F.array(F.lit(2.0), F.lit(0.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0)))
    n = F.when(k % 4 == 0, 15).when(k % 2 == 0, 16).otherwise(256)
    files = c.select(k.alias("event"), (k % 3).alias("patch"), name.alias("file"), F.when(k % 2 == 0, 2).otherwise(F.when(k % 11 == 0, 3).otherwise(1)).alias("bands"), n.alias("h"), n.alias("w"), data.alias("data"))
    return R.quality_issues(files).select("event", "patch", "file", "check")


def _targets(spark, n):
    x = spark.range(n).select(F.col("id").cast("int").alias("row"))
    return x.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def nearest(spark, d):
    src = T.raster(spark, d)
    grid = _targets(spark, 10)
    targets = grid.withColumn("event", F.explode(F.array(F.lit("F"), F.lit("O"))))
    return R.nearest(src, targets, 6.4, 6.4).select("event", "row", "col", F.round("value", 6).alias("value"))


def average(spark, d):
    out = R.average(T.raster(spark, d), 6.4, 6.4)
    return out.select("event", "row", "col", F.round("value", 1).alias("value"))


def mosaic(spark, d):
    x = T.table(spark, d, "lineitem")
    tiles = x.groupBy((F.col("l_orderkey") % 3).cast("string").alias("event"), (F.col("l_suppkey") % 5).alias("ord"), (F.col("l_partkey") % 16).cast("int").alias("row"), (F.col("l_linenumber") % 16).cast("int").alias("col")).agg(F.max(F.when(F.col("l_discount") > 0.03, F.col("l_extendedprice"))).alias("value"))
    return R.mosaic(tiles).select("event", "row", "col", F.round("value", 6).alias("value"))


def cubic(spark, d):
    """The 64 numbers of an embedding as an 8 x 8 tile, without a halo, on a grid of 4 x 4."""
    t = T.table(spark, d, "embeddings").select(F.lit("e").alias("event"), F.col("vec_id").alias("tile"), F.lit(8).alias("size"), F.lit(0).alias("halo"), F.col("embedding").cast("array<double>").alias("data"))
    return R.cubic(t, 4)


def areas(spark, d):
    m = T.raster(spark, d).select("event", "row", F.when(F.col("value") > 30000, 1).otherwise(0).alias("value"), F.lit(0.01).alias("res_x"), F.lit(0.01).alias("res_y"), F.when(F.col("event") == "F", 10.0).otherwise(60.0).alias("top"))
    return R.mask_areas(m)


def masks(spark, d):
    poly = T.polygons(spark).select(F.col("poly_id").cast("string").alias("event"), "rings")
    grid = poly.select("event", F.lit(72).alias("w"), F.lit(36).alias("h"), F.lit(-180.0).alias("minx"), F.lit(90.0).alias("maxy"), F.lit(5.0).alias("res"))
    return P.rasterized(poly, grid)


def point_in_polygon(spark, d):
    return P.within(T.points(spark, d), T.polygons(spark))


def nearest_polygon(spark, d):
    out = P.nearest(T.points(spark, d), T.polygons(spark), 12.0)
    return out.select("pid", "poly_id", F.round("dist", 4).alias("dist"))


def basins(spark, d):
    return P.basin(T.points(spark, d), T.polygons(spark), 12.0)


def continents(spark, d):
    """Every point gets a continent, however far it lies from the polygons."""
    c = T.polygons(spark).withColumn("continent", F.element_at(F.array(*map(F.lit, ("Africa", "Asia", "North America", "Oceania"))), F.col("poly_id").cast("int")))
    return P.continent(T.points(spark, d), c)


def centroids(spark, d):
    x = T.polygons(spark).select("poly_id", geo.edges(F.col("rings")).alias("s"))
    x = x.where("poly_id <> 1").select("poly_id", geo.centroid(F.col("s")).alias("c"), geo.bounds(F.col("s")).alias("b"))
    return x.select("poly_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"), F.round("c.area", 4).alias("area"), "b.minx", "b.maxy")


def overlaps(spark, d):
    """Polygons by how many boxes around points touch their bounds."""
    b = F.broadcast(T.polygons(spark).select("poly_id", geo.bounds(geo.edges(F.col("rings"))).alias("b")))
    box = F.struct(F.col("x").alias("minx"), F.col("y").alias("miny"), F.col("x2").alias("maxx"), F.col("y2").alias("maxy"))
    return _box(spark, d).select(box.alias("a")).join(b, geo.overlap(F.col("a"), F.col("b"))).groupBy("poly_id").agg(F.count("*").alias("n"))


def zones(spark, d):
    cells = T.points(spark, d).select("x", "y", (F.col("pid") % 31).cast("int").alias("value"))
    return P.zonal_majority(cells, T.polygons(spark).withColumnRenamed("poly_id", "event"))


def projections(spark, d):
    """Web Mercator, and UTM's zone with a round check on the central meridian, where easting is 500 km."""
    p = T.points(spark, d).where("abs(y) < 80")
    m, z = geo.mercator(F.col("x"), F.col("y")), geo.utm_zone(F.col("x"))
    return p.select("pid", F.round(m["x"], 3).alias("mx"), F.round(m["y"], 3).alias("my"), z.alias("zone"), F.round(geo.utm((z * 6 - 183).cast("double"), F.col("y"), z)["x"], 3).alias("easting"))


_BEFORE = f"ts < TIMESTAMP '{T.EVENT_DAY}'"
_CROSS = "count(*) FILTER (((ay > y) <> (by > y)) AND x < (bx - ax) * (y - ay) / (by - ay) + ax) % 2 = 1"
_INSIDE = f"hit AS (SELECT pid, x, y, poly_id FROM pts CROSS JOIN seg WHERE ay <> by GROUP BY 1, 2, 3, 4 HAVING {_CROSS}), held AS (SELECT pid, min(poly_id) AS poly_id FROM hit GROUP BY 1)"
_DIST = """dd AS (SELECT pid, poly_id, min(sqrt(power(ax + u * (bx - ax) - x, 2) + power(ay + u * (by - ay) - y, 2))) AS dist FROM
 (SELECT *, greatest(0, least(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) * (bx - ax) + (by - ay) * (by - ay)))) AS u FROM pts CROSS JOIN seg) GROUP BY 1, 2),
 d2 AS (SELECT dd.pid, dd.poly_id, CASE WHEN hit.poly_id IS NOT NULL THEN 0.0 ELSE dist END AS dist FROM dd LEFT JOIN hit ON hit.pid = dd.pid AND hit.poly_id = dd.poly_id)"""
_GEO = f"WITH {T.PTS}, {T.SEG}, {_INSIDE}"


def _stages(conds: list[str], labels: list, least: float, rows: str) -> str:
    """Medians and coverage of each stage, as the operator decides on them."""
    med = ", ".join(f"median(value) FILTER ({c}) AS v{k}, count(*) FILTER ({c}) AS n{k}" for k, c in enumerate(conds))
    cov = ", ".join(f"100.0 * sum(CASE WHEN v{k} IS NOT NULL THEN area ELSE 0 END) / sum(area) AS c{k}, sum(coalesce(n{k}, 0)) AS m{k}" for k in range(len(conds)))
    n = range(len(conds))
    used = "coalesce(" + ", ".join(f"CASE WHEN m{k} > 0 AND c{k} >= {least} THEN {k} END" for k in n) + ", greatest(" + ", ".join(f"CASE WHEN m{k} > 0 THEN {k} ELSE 0 END" for k in n) + "))"
    fill = "coalesce(" + ", ".join(f"CASE WHEN {k} <= used THEN v{k} END" for k in n) + ")"
    return f"""WITH {T.AQ}, {T.PX}, ob AS ({rows}), md AS (SELECT pixel, {med} FROM ob GROUP BY 1), wd AS (SELECT px.*, md.* EXCLUDE (pixel) FROM px LEFT JOIN md USING (pixel)),
 tt AS (SELECT {cov} FROM wd), us AS (SELECT *, {used} AS used FROM tt), dc AS (SELECT used, list_extract([{", ".join(f"c{k}" for k in n)}], CAST(used + 1 AS BIGINT)) AS coverage FROM us)
 SELECT pixel, round({fill}, 6) AS value, list_extract([{", ".join(map(str, labels))}], CAST(used + 1 AS BIGINT)) AS stage, round(coverage, 6) AS coverage, coverage >= {least} AS ok"""


def _series_sql(agg: str) -> str:
    return f"""WITH {T.AQ}, {T.PX}, dy AS (SELECT pixel, CAST(date_diff('day', DATE '{T.EVENT_DAY}' - INTERVAL 12 DAY, CAST(ts AS DATE)) AS INTEGER) AS k, {agg} AS v FROM aq WHERE {_BEFORE} AND ts >= DATE '{T.EVENT_DAY}' - INTERVAL 12 DAY GROUP BY 1, 2),
 al AS (SELECT pixel, CAST(unnest(range(12)) AS INTEGER) AS k FROM px) SELECT pixel, k, round(coalesce(v, 9999.0), 6) AS v FROM al LEFT JOIN dy USING (pixel, k)"""


_BOX = f"WITH {T.PTS}, bx AS (SELECT pid, x, y, x + 1.37::DOUBLE AS x2, y + 0.83::DOUBLE AS y2 FROM pts)"
_WIDE = _stages([f"CAST(ts AS DATE) >= DATE '{T.EVENT_DAY}' - INTERVAL {n} DAY" for n in (1, 2, 5, 15)], [1, 2, 5, 15], 90.0, f"SELECT * FROM aq WHERE mode = 'IW' AND dual AND {_BEFORE} AND ts >= DATE '{T.EVENT_DAY}' - INTERVAL 15 DAY")
_RELAX = _stages([f"cloud_pct < {n}" for n in (3, 6, 12, 40)], [3, 6, 12, 40], 95.0, f"SELECT * FROM aq WHERE {_BEFORE} AND ts >= DATE '{T.EVENT_DAY}' - INTERVAL 8 DAY")
_OVER = "least((\"{c}\" + 1) / 6.4, t{c} + 1) - greatest(\"{c}\" / 6.4, t{c})"

_CUBE = "CASE WHEN abs({d}) < 1 THEN 1.5::DOUBLE * abs({d}) * abs({d}) * abs({d}) - 2.5::DOUBLE * abs({d}) * abs({d}) + 1 WHEN abs({d}) < 2 THEN -0.5::DOUBLE * abs({d}) * abs({d}) * abs({d}) + 2.5::DOUBLE * abs({d}) * abs({d}) - 4 * abs({d}) + 2 ELSE 0 END"
_PATCHES = f"""WITH {T.RS}, ev AS (SELECT DISTINCT event FROM rs), i AS (SELECT unnest(range(64)) AS i),
 cells AS (SELECT event, a.i AS r, b.i AS c FROM ev, i AS a, i AS b),
 ca AS (SELECT event, r, c, (70.125::DOUBLE - (64 - (r + 0.5::DOUBLE))) / 2 AS y, (c + 0.5::DOUBLE + 3.25::DOUBLE) / 2 AS x FROM cells),
 taps AS (SELECT ca.*, CAST(floor(y - 0.5) AS INTEGER) + dr AS sr, CAST(floor(x - 0.5) AS INTEGER) + dc AS sc FROM ca, (SELECT unnest([-1, 0, 1, 2]) AS dr) AS p, (SELECT unnest([-1, 0, 1, 2]) AS dc) AS q),
 w AS (SELECT taps.*, rs.value::DOUBLE AS v, ({_CUBE.format(d="(y - 0.5::DOUBLE - sr)")}) * ({_CUBE.format(d="(x - 0.5::DOUBLE - sc)")}) AS k FROM taps JOIN rs ON rs.event = taps.event AND rs."row" = sr AND rs.col = sc WHERE rs.value IS NOT NULL),
 cubic AS (SELECT event, r, c, sum(k * v) / sum(k) AS v FROM w GROUP BY 1, 2, 3 HAVING bool_or(sr = floor(y) AND sc = floor(x)) AND abs(sum(k)) > 1e-12),
 fine AS (SELECT cells.*, 'fine' AS file, 1 AS f, 1 AS slot, coalesce(v, 9999.0) AS v FROM cells LEFT JOIN cubic USING (event, r, c)),
 wet AS (SELECT cells.*, CASE WHEN value > 50000 THEN 1.0 ELSE 0.0 END AS v FROM cells LEFT JOIN rs ON rs.event = cells.event AND rs."row" = floor(63.25::DOUBLE - (64 - (r + 0.5::DOUBLE))) AND rs.col = floor(c + 0.5::DOUBLE - 0.5::DOUBLE)),
 near AS (SELECT cells.*, coalesce(value::DOUBLE, 9999.0) AS v FROM cells LEFT JOIN rs ON rs.event = cells.event AND rs."row" = floor((66.5::DOUBLE - (64 - (r + 0.5::DOUBLE))) / 1.625::DOUBLE) AND rs.col = floor((c + 0.5::DOUBLE + 1.75::DOUBLE) / 1.625::DOUBLE)),
 j AS (SELECT unnest(range(8)) AS j), cc AS (SELECT event, a.j AS r, b.j AS c FROM ev, j AS a, j AS b),
 lap AS (SELECT cc.*, rs.value::DOUBLE AS v, (least((-2.5::DOUBLE + (rs."row" + 1) * 1.625::DOUBLE) / 8, r + 1) - greatest((-2.5::DOUBLE + rs."row" * 1.625::DOUBLE) / 8, r)) AS kr,
  (least((-1.75::DOUBLE + (rs.col + 1) * 1.625::DOUBLE) / 8, c + 1) - greatest((-1.75::DOUBLE + rs.col * 1.625::DOUBLE) / 8, c)) AS kc FROM cc JOIN rs USING (event) WHERE rs.value IS NOT NULL),
 mean AS (SELECT event, r, c, sum(v * kr * kc) / sum(kr * kc) AS v FROM lap WHERE kr > 1e-9 AND kc > 1e-9 GROUP BY 1, 2, 3),
 allc AS (SELECT event, r, c, file, f, slot, v FROM fine UNION ALL SELECT event, r, c, 'fine', 1, 2, v FROM wet UNION ALL SELECT event, r, c, 'fine', 1, 3, v FROM near
  UNION ALL SELECT event, r, c, 'flood_mask', 1, 1, v FROM wet UNION ALL SELECT cc.event, cc.r, cc.c, 'coarse', 8, 1, coalesce(v, 9999.0) FROM cc LEFT JOIN mean USING (event, r, c) UNION ALL SELECT event, r, c, 'coarse', 8, 2, 9999.0 FROM cc),
 o AS (SELECT unnest([0, 1, 2]) AS k), p AS (SELECT allc.*, a.k * 3 + b.k AS patch_number, a.k * 16 AS row0, b.k * 16 AS col0, r - a.k * 16 // f AS pr, c - b.k * 16 // f AS pc FROM allc, o AS a, o AS b
  WHERE r >= a.k * 16 // f AND r < a.k * 16 // f + 32 // f AND c >= b.k * 16 // f AND c < b.k * 16 // f + 32 // f),
 good AS (SELECT event, patch_number, sum(CASE WHEN file = 'flood_mask' AND v = 1 THEN 1 ELSE 0 END) AS flood_pixels, min(row0) AS row0, min(col0) AS col0 FROM p GROUP BY 1, 2 HAVING avg(CASE WHEN v = 9999.0 THEN 0.0 ELSE 1.0 END) FILTER (file = 'fine') >= 0.6)
 SELECT event, CAST(patch_number AS INTEGER) AS patch_number, file, slot, count(*) AS n, count(v) FILTER (v <> 9999.0) AS valid, round(avg(v) FILTER (v <> 9999.0), 3) AS mean, round(avg(v * (pr + 2 * pc)) FILTER (v <> 9999.0), 2) AS placed,
  CAST(good.col0 AS DOUBLE) AS bounds_minx, CAST(64 - good.row0 - 32 AS DOUBLE) AS bounds_miny, CAST(good.col0 + 32 AS DOUBLE) AS bounds_maxx, CAST(64 - good.row0 AS DOUBLE) AS bounds_maxy, CAST(flood_pixels AS BIGINT) AS flood_pixels
 FROM p JOIN good USING (event, patch_number) GROUP BY ALL"""

QUERIES = {
    "composite_median": (median, f"WITH {T.AQ} SELECT pixel, round(median(value), 6) AS value FROM aq WHERE mode = 'IW' AND dual GROUP BY 1"),
    "composite_widening": (widening, _WIDE + " FROM wd CROSS JOIN dc"),
    "composite_cloud_relax": (relaxing, _RELAX + ", false AS uses_future FROM wd CROSS JOIN dc"),
    "index_ndvi": (indices, f"""WITH {T.AQ}, x AS (SELECT pixel, median(value) FILTER (mode = 'IW') AS a, median(value) FILTER (cloud_pct < 50) AS b FROM aq GROUP BY 1) SELECT pixel, round((a - b) / nullif(a + b, 0), 6) AS nd, round(coalesce(a, b), 6) AS filled FROM x"""),
    "coverage_pct": (covered, f"WITH {T.AQ}, {T.PX}, x AS (SELECT pixel, max(value) AS v FROM aq WHERE cloud_pct < 2 GROUP BY 1) SELECT round(100.0 * sum(CASE WHEN v IS NOT NULL THEN area ELSE 0 END) / sum(area), 6) AS pct FROM px LEFT JOIN x USING (pixel)"),
    "composite_widening_events": (widening_events, T.sql_of_each_event(_WIDE + " FROM wd CROSS JOIN dc")),
    "composite_relax_events": (relaxing_events, T.sql_of_each_event(_RELAX + ", false AS uses_future FROM wd CROSS JOIN dc")),
    "daily_series_events": (rain_events, T.sql_of_each_event(_series_sql("sum(value) * 0.5"))),
    "daily_series": (daily_rain, _series_sql("sum(value) * 0.5")),
    "daily_first": (daily_moisture, _series_sql("first(value ORDER BY ts, value)")),
    "open_water": (water, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 * 40 = 80 THEN 1 ELSE 0 END AS water FROM orders"),
    "snap_bounds": (snap, _BOX + " SELECT pid, round(floor(x / 0.1::DOUBLE) * 0.1::DOUBLE, 6) AS minx, round(floor(y / 0.1::DOUBLE) * 0.1::DOUBLE, 6) AS miny, round(ceil(x2 / 0.1::DOUBLE) * 0.1::DOUBLE, 6) AS maxx, round(ceil(y2 / 0.1::DOUBLE) * 0.1::DOUBLE, 6) AS maxy, round(ceil(y2 / 0.1::DOUBLE) * 0.1::DOUBLE, 6) AS origin_y FROM bx"),
    "buffer_bounds": (buffer, _BOX + " SELECT pid, round(greatest(x - 0.6, -180), 6) AS minx, round(greatest(y - 0.6, -90), 6) AS miny, round(least(x2 + 0.6, 180), 6) AS maxx, round(least(y2 + 0.6, 90), 6) AS maxy FROM bx"),
    "grid_affine": (grids, _BOX + ", g AS (SELECT *, CAST(floor((x2 - x) / 0.25) AS INTEGER) AS w, CAST(floor((y2 - y) / 0.25) AS INTEGER) AS h FROM bx) SELECT pid, w, h, round((x2 - x) / w, 6) AS a, round(-(y2 - y) / h, 6) AS e, round((x2 - x) / w + x, 6) AS minx, round(-(y2 - y) / h + y2, 6) AS maxy, round(-(y2 - y) / h * 3 + y2, 6) AS miny FROM g"),
    "d8_sincos": (directions, "WITH x AS (SELECT o_orderkey AS id, o_orderkey % 10 AS k FROM orders) SELECT id, CASE WHEN k < 8 THEN round(sin(radians(k * 45)), 6) + 0.0 ELSE 9999 END AS s, CASE WHEN k < 8 THEN round(cos(radians(k * 45)), 6) + 0.0 ELSE 9999 END AS c FROM x"),
    "patch_grid": (patch_grid, """WITH s AS (SELECT c_custkey AS event, c_custkey * 13 % 900 AS w, c_custkey * 7 % 800 AS h FROM customer), n AS (SELECT event, w // 256 AS nc, h // 256 AS nr FROM s), r AS (SELECT *, unnest(range(nr)) AS r FROM n), c AS (SELECT *, unnest(range(nc)) AS c FROM r)
 SELECT event, CAST(r * nc + c AS INTEGER) AS patch_number, CAST(r * 256 AS INTEGER) AS row0, CAST(c * 256 AS INTEGER) AS col0 FROM c"""),
    "patch_cut": (patch_cut, f"""WITH {T.RS}, f AS (SELECT event, CAST("row" // 8 * 8 + col // 8 AS INTEGER) AS patch_number, count(value) AS n, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS valid FROM rs GROUP BY 1, 2),
 c AS (SELECT event, CAST("row" // 2 * 8 + col // 2 AS INTEGER) AS patch_number, count(*) AS coarse FROM rs WHERE "row" < 16 AND col < 16 GROUP BY 1, 2) SELECT f.*, coarse FROM f LEFT JOIN c USING (event, patch_number)"""),
    "patch_stack": (patch_stack, _PATCHES),
    "patch_valid_ratio": (valid_patches, f"""WITH {T.RS} SELECT event, CAST("row" // 8 * 8 + col // 8 AS INTEGER) AS patch_number FROM rs GROUP BY 1, 2 HAVING avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END) >= 0.9"""),
    "patch_flood_pixels": (flood_pixels, f"WITH {T.EV}, {T.PT} SELECT folder_name, CAST(sum(flood_pixels) AS BIGINT) AS flood_pixels, round(max(flood_pixels / 65536), 6) AS most FROM pt GROUP BY 1"),
    "patch_qc": (quality, """WITH x AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'input_160m' ELSE 'flood_mask' END AS file FROM customer), y AS (SELECT *, unnest(['missing', 'band_count', 'shape', 'nan_inf', 'mask_not_binary']) AS "check" FROM x)
 SELECT k AS event, k % 3 AS patch, file, "check" FROM y WHERE CASE "check" WHEN 'missing' THEN k % 9 = 0 WHEN 'band_count' THEN k % 9 <> 0 AND k % 2 = 1 AND k % 11 = 0 WHEN 'shape' THEN k % 9 <> 0 AND k % 4 = 0 WHEN 'nan_inf' THEN k % 9 <> 0 AND k % 7 = 0 ELSE k % 9 <> 0 AND k % 2 = 1 AND (k % 7 = 0 OR k % 5 = 0) END"""),
    "resample_nearest": (nearest, f"""WITH {T.RS}, g AS (SELECT unnest(range(10)) AS r), h AS (SELECT r, unnest(range(10)) AS c FROM g), t AS (SELECT r, c, unnest(['F', 'O']) AS event FROM h)
 SELECT t.event, CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, round(value, 6) AS value FROM t LEFT JOIN rs ON rs.event = t.event AND rs."row" = floor((r + 0.5) * 6.4) AND rs.col = floor((c + 0.5) * 6.4)"""),
    "resample_average": (average, f"""WITH {T.RS}, a AS (SELECT *, unnest(range(CAST(floor("row" / 6.4 + 1e-9) AS BIGINT), CAST(ceil(("row" + 1) / 6.4 - 1e-9) AS BIGINT))) AS trow FROM rs), b AS (SELECT *, unnest(range(CAST(floor(col / 6.4 + 1e-9) AS BIGINT), CAST(ceil((col + 1) / 6.4 - 1e-9) AS BIGINT))) AS tcol FROM a),
 w AS (SELECT *, ({_OVER.format(c="row")}) * ({_OVER.format(c="col")}) AS w FROM b) SELECT event, CAST(trow AS INTEGER) AS "row", CAST(tcol AS INTEGER) AS col, round(sum(value * w) FILTER (value IS NOT NULL) / sum(w) FILTER (value IS NOT NULL), 1) AS value FROM w GROUP BY 1, 2, 3"""),
    "mosaic_first": (mosaic, """WITH t AS (SELECT CAST(l_orderkey % 3 AS VARCHAR) AS event, l_suppkey % 5 AS ord, CAST(l_partkey % 16 AS INTEGER) AS "row", CAST(l_linenumber % 16 AS INTEGER) AS col, max(CASE WHEN l_discount > 0.03 THEN l_extendedprice END) AS value FROM lineitem GROUP BY 1, 2, 3, 4)
 SELECT event, "row", col, round(first(value ORDER BY ord) FILTER (value IS NOT NULL), 6) AS value FROM t GROUP BY 1, 2, 3"""),
    "resample_cubic": (cubic, None),
    "mask_areas": (areas, f"""WITH {T.RS}, m AS (SELECT event, CASE WHEN value > 30000 THEN 1 ELSE 0 END AS v, 0.01::DOUBLE * 111320 * cos(radians(CASE event WHEN 'F' THEN 10.0 ELSE 60.0 END - ("row" + 0.5) * 0.01::DOUBLE)) * (0.01::DOUBLE * 110540) / 1e6 AS a FROM rs)
 SELECT event, round(sum(a), 2) AS aoi_area_km2, round(sum(a * v), 2) AS flooded_area_km2 FROM m GROUP BY 1"""),
    "rasterize_mask": (masks, f"""WITH {T.SEG}, g AS (SELECT unnest(range(36)) AS r), h AS (SELECT r, unnest(range(72)) AS c FROM g), pts AS (SELECT r, c, -180 + (c + 0.5) * 5::DOUBLE AS x, 90 - (r + 0.5) * 5::DOUBLE AS y FROM h)
 SELECT CAST(poly_id AS VARCHAR) AS event, CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col FROM pts CROSS JOIN seg WHERE ay <> by GROUP BY 1, 2, 3 HAVING {_CROSS}"""),
    "point_in_polygon": (point_in_polygon, _GEO + " SELECT * FROM held"),
    "nearest_polygon": (nearest_polygon, _GEO + f", {_DIST} SELECT pid, first(poly_id ORDER BY dist, poly_id) AS poly_id, round(min(dist), 4) AS dist FROM d2 WHERE dist < 12 GROUP BY 1"),
    "basin_lookup": (basins, _GEO + f", {_DIST} SELECT pid, coalesce(held.poly_id, near.poly_id) AS poly_id FROM held FULL JOIN (SELECT pid, first(poly_id ORDER BY dist, poly_id) AS poly_id FROM d2 WHERE dist < 12 GROUP BY 1) AS near USING (pid)"),
    "continent_lookup": (continents, None),
    "polygon_centroid": (centroids, f"""WITH {T.SEG}, c AS (SELECT *, ax * by - bx * ay AS c FROM seg WHERE poly_id <> 1) SELECT poly_id, round(sum((ax + bx) * c) / 6 / (sum(c) / 2), 6) AS x, round(sum((ay + by) * c) / 6 / (sum(c) / 2), 6) AS y, round(sum(c) / 2, 4) AS area, min(ax) AS minx, max(ay) AS maxy FROM c GROUP BY 1"""),
    "bbox_overlap": (overlaps, f"""WITH {T.PTS}, {T.SEG}, b AS (SELECT poly_id, min(ax) AS x0, min(ay) AS y0, max(ax) AS x1, max(ay) AS y1 FROM seg GROUP BY 1) SELECT poly_id, count(*) AS n FROM pts JOIN b ON x <= x1 AND x0 <= x + 1.37::DOUBLE AND y <= y1 AND y0 <= y + 0.83::DOUBLE GROUP BY 1"""),
    "zonal_majority": (zones, _GEO + """, z AS (SELECT poly_id AS event, CASE WHEN pid % 31 <= 3 THEN 'A' WHEN pid % 31 <= 7 THEN 'B' WHEN pid % 31 <= 16 THEN 'C' WHEN pid % 31 <= 28 THEN 'D' ELSE 'E' END AS letter FROM hit WHERE pid % 31 > 0), k AS (SELECT event, letter, count(*) AS n FROM z GROUP BY 1, 2)
 SELECT event, first(letter ORDER BY n DESC, letter) AS letter FROM k GROUP BY 1"""),
    "crs_projection": (projections, f"WITH {T.PTS} SELECT pid, round(radians(x) * 6378137.0, 3) AS mx, round(ln(tan(radians(y) / 2 + pi() / 4)) * 6378137.0, 3) AS my, CAST(floor((x + 180) / 6) % 60 + 1 AS INTEGER) AS zone, CAST(500000 AS DOUBLE) AS easting FROM pts WHERE abs(y) < 80"),
}
# "by" is a word of SQL, and the name of a segment's last coordinate.
QUERIES = {name: (run, sql and re.sub(r"\bby\b", '"by"', sql)) for name, (run, sql) in QUERIES.items()}
