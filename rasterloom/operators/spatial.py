"""Joins of points, polygons and grids over integer cells.

Polygons are unfolded to the cells that their bounds touch and points to their cell, so
a spatial join is an equi-join on the cell with an exact check after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import geo
from rasterloom.session import materialize


def _cells(lo_x: Column, lo_y: Column, hi_x: Column, hi_y: Column, size: float) -> Column:
    span = lambda a, b: F.sequence(F.floor(a / size), F.floor(b / size))
    return F.flatten(F.transform(span(lo_x, hi_x), lambda x: F.transform(span(lo_y, hi_y), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def prepared(polygons: DataFrame, size: float, reach: float = 0.0) -> DataFrame:
    """``poly_id, segs`` and a row for each cell within ``reach`` of the polygon's bounds."""
    p = polygons.withColumn("segs", geo.edges(F.col("rings"))).where(F.size("rings") > 0).withColumn("b", geo.bounds(F.col("segs")))
    return p.withColumn("cell", F.explode(_cells(F.col("b.minx") - reach, F.col("b.miny") - reach, F.col("b.maxx") + reach, F.col("b.maxy") + reach, size))).drop("b", "rings")


def _cell(points: DataFrame, size: float) -> DataFrame:
    return points.withColumn("cell", F.struct(F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy")))


def within(points: DataFrame, polygons: DataFrame, size: float = 10.0) -> DataFrame:
    """``pid, poly_id``: of the polygons that hold a point the one of the least id; points in none are left out."""
    pairs = _cell(points, size).join(prepared(polygons, size), "cell")
    return pairs.where(geo.inside(F.col("segs"), F.col("x"), F.col("y"))).groupBy("pid").agg(F.min("poly_id").alias("poly_id"))


def nearest(points: DataFrame, polygons: DataFrame, reach: float, size: float = 10.0) -> DataFrame:
    """``pid, poly_id, dist`` of the nearest polygon closer than ``reach``; the least id of several."""
    pairs = _cell(points, size).join(prepared(polygons, size, reach), "cell")
    d = F.when(geo.inside(F.col("segs"), F.col("x"), F.col("y")), 0.0).otherwise(geo.boundary_distance(F.col("segs"), F.col("x"), F.col("y")))
    near = pairs.withColumn("dist", d).where(F.col("dist") < reach).groupBy("pid").agg(F.min(F.struct("dist", "poly_id")).alias("m"))
    return near.select("pid", "m.poly_id", "m.dist")


def nearest_any(points: DataFrame, polygons: DataFrame, first: float, size: float) -> DataFrame:
    """The nearest polygon however far: points without one within a radius are asked again with twice the radius."""
    left, out, reach = materialize(points.select("pid", "x", "y")), None, first
    some = polygons.limit(1).count() > 0
    while some and left.limit(1).count():
        got = materialize(nearest(left, polygons, reach, max(size, reach)))
        out = got if out is None else out.unionByName(got)
        left, reach = materialize(left.join(got, "pid", "left_anti")), reach * 2
    return out if out is not None else points.limit(0).select("pid", F.lit(None).cast("long").alias("poly_id"), F.lit(0.0).alias("dist"))


def basin(points: DataFrame, basins: DataFrame, reach: float = 0.5) -> DataFrame:
    """``pid, poly_id``: the basin that holds a point, else the nearest one within reach."""
    held = within(points, basins)
    rest = points.join(held, "pid", "left_anti")
    return held.unionByName(nearest(rest, basins, reach).select("pid", "poly_id"))


def continent(points: DataFrame, countries: DataFrame) -> DataFrame:
    """``pid, continent`` with labels; points in no country go to the nearest one in Web Mercator."""
    held = within(points, countries)
    project = lambda lon, lat: geo.mercator(lon, F.greatest(F.least(lat, F.lit(89.0)), F.lit(-89.0)))
    flat = countries.withColumn("rings", F.transform("rings", lambda r: F.transform(r, lambda p: project(p["x"], p["y"]))).cast(geo.RINGS))
    away = points.join(held, "pid", "left_anti").withColumn("m", project(F.col("x"), F.col("y"))).select("pid", F.col("m.x").alias("x"), F.col("m.y").alias("y"))
    near = nearest_any(away, flat, 1e5, 1e6).select("pid", "poly_id")
    named = held.unionByName(near).join(countries.select("poly_id", "continent"), "poly_id").join(points, "pid")
    return named.select("pid", geo.continent_label(F.col("continent"), F.col("x"), F.col("y")).alias("continent"))


def rasterized(polygons: DataFrame, grids: DataFrame) -> DataFrame:
    """Pixels whose centre is inside: ``event, row, col``. ``polygons(event, rings)``, ``grids(event, w, h, minx, maxy, res)``.

    Row by row: a row's crossings with the boundary, sorted, pair up to runs of pixels.
    """
    p = polygons.where(F.size("rings") > 0).withColumn("segs", geo.edges(F.col("rings"))).drop("rings")
    rows = grids.join(p, "event").withColumn("row", F.explode(F.sequence(F.lit(0), F.col("h").cast("int") - 1))).withColumn("y", F.col("maxy") - (F.col("row") + 0.5) * F.col("res"))
    hits = F.filter("segs", lambda s: (s["ay"] > F.col("y")) != (s["by"] > F.col("y")))
    xs = F.array_sort(F.transform(hits, lambda s: (s["bx"] - s["ax"]) * (F.col("y") - s["ay"]) / (s["by"] - s["ay"]) + s["ax"]))
    rows = rows.withColumn("xs", xs).where(F.size("xs") > 0).drop("segs")
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1)))
    at = lambda k: F.ceil((F.element_at("xs", k) - F.col("minx")) / F.col("res") - 0.5).cast("int")
    rows = rows.withColumn("c0", F.greatest(at(F.col("k") * 2 + 1), F.lit(0))).withColumn("c1", F.least(at(F.col("k") * 2 + 2) - 1, F.col("w").cast("int") - 1)).where("c0 <= c1")
    return rows.select("event", "row", F.explode(F.sequence("c0", "c1")).alias("col")).distinct()


def zonal_majority(cells: DataFrame, zones: DataFrame, value: str = "value", size: float = 10.0) -> DataFrame:
    """``event, letter``: the most frequent climate class of the cells ``(x, y, value)`` in each zone ``(event, rings)``, the first letter of several."""
    z = zones.withColumnRenamed("event", "poly_id")
    pairs = _cell(cells.where(F.col(value) > 0), size).join(prepared(z, size), "cell")
    got = pairs.where(geo.inside(F.col("segs"), F.col("x"), F.col("y"))).withColumn("letter", geo.climate_class(F.col(value)))
    return got.groupBy(F.col("poly_id").alias("event")).agg(F.mode("letter", True).alias("letter"))
