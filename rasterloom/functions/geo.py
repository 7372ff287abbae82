"""Grids, projections, polygons and classes as column expressions.

A polygon is an array of rings, a ring an array of ``struct<x, y>``; rings are closed
implicitly, and the even-odd rule makes inner rings holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterloom.config import DEFAULTS

RINGS = "array<array<struct<x:double,y:double>>>"
# Flow directions, climate classes, continent names.
D8 = {1: 0.0, 2: 45.0, 4: 90.0, 8: 135.0, 16: 180.0, 32: 225.0, 64: 270.0, 128: 315.0}
CLIMATE = ((3, "A", "A Tropical"), (7, "B", "B Arid"), (16, "C", "C Temperate"), (28, "D", "D Cold"), (30, "E", "E Polar"))
CONTINENT = {"Oceania": "Australia/Oceania"}


def snapped(minx: Column, miny: Column, maxx: Column, maxy: Column, pixel: Column) -> Column:
    """Bounds moved outward to the pixel grid, and the origin of its transform."""
    down, up = lambda v: F.floor(v / pixel) * pixel, lambda v: F.ceil(v / pixel) * pixel
    return F.struct(down(minx).alias("minx"), down(miny).alias("miny"), up(maxx).alias("maxx"), up(maxy).alias("maxy"), F.array(pixel, F.lit(0.0), down(minx), F.lit(0.0), -pixel, up(maxy)).alias("transform"))


def buffered(minx: Column, miny: Column, maxx: Column, maxy: Column, deg: float = DEFAULTS.buffer_deg) -> Column:
    return F.struct(
        F.greatest(minx - deg, F.lit(-180.0)).alias("minx"), F.greatest(miny - deg, F.lit(-90.0)).alias("miny"), F.least(maxx + deg, F.lit(180.0)).alias("maxx"), F.least(maxy + deg, F.lit(90.0)).alias("maxy")
    )


def grid(minx: Column, miny: Column, maxx: Column, maxy: Column, res: Column | float) -> Column:
    """Whole pixels of an extent, and the affine transform that stretches them over it."""
    res = F.lit(res) if isinstance(res, (int, float)) else res
    w, h = F.floor((maxx - minx) / res).cast("int"), F.floor((maxy - miny) / res).cast("int")
    t = F.struct(((maxx - minx) / w).alias("a"), F.lit(0.0).alias("b"), minx.alias("c"), F.lit(0.0).alias("d"), (-(maxy - miny) / h).alias("e"), maxy.alias("f"))
    return F.struct(w.alias("w"), h.alias("h"), t.alias("transform"))


def at_pixel(t: Column, col: Column, row: Column) -> Column:
    """The point of a pixel's upper left corner."""
    return F.struct((t["a"] * col + t["b"] * row + t["c"]).alias("x"), (t["d"] * col + t["e"] * row + t["f"]).alias("y"))


def patch_bounds(t: Column, col: Column, row: Column, size: int) -> Column:
    a, b = at_pixel(t, col, row), at_pixel(t, col + size, row + size)
    return F.struct(a["x"].alias("minx"), b["y"].alias("miny"), b["x"].alias("maxx"), a["y"].alias("maxy"))


def degrees(metres: Column) -> Column:
    return metres / 111000.0


def row_area_km2(res_x: Column, res_y: Column, lat: Column) -> Column:
    """Ground area of one pixel of a geographic grid in the row at a latitude."""
    return res_x * DEFAULTS.m_per_deg_lon * F.cos(F.radians(lat)) * (res_y * DEFAULTS.m_per_deg_lat) / 1e6


def flow(code: Column, nodata: float = DEFAULTS.nodata) -> Column:
    """Sine and cosine of a flow direction; other codes have none."""
    angle = F.try_element_at(F.create_map(*(F.lit(x) for kv in D8.items() for x in kv)), code.cast("int"))
    return F.struct(F.coalesce(F.sin(F.radians(angle)), F.lit(nodata)).alias("sin"), F.coalesce(F.cos(F.radians(angle)), F.lit(nodata)).alias("cos"))


def climate_class(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for top, letter, _ in reversed(CLIMATE):
        out = F.when(value <= top, letter).otherwise(out)
    return F.when(value > 0, out)


def climate_label(letter: Column) -> Column:
    out = F.lit(None).cast("string")
    for _, c, label in CLIMATE:
        out = F.when(letter == c, label).otherwise(out)
    return out


def continent_label(name: Column, lon: Column, lat: Column) -> Column:
    """The catalogue's name; islands south-east of Asia are Oceania's, land west of the straits Europe's."""
    label = name
    for k, v in CONTINENT.items():
        label = F.when(name == k, v).otherwise(label)
    label = F.when((label == "Asia") & (lat < -1) & (lon >= 120), "Australia/Oceania").otherwise(label)
    return F.when((label == "Asia") & (lon <= 30) & (lat >= 40), "Europe").otherwise(label)


def basin_l5(pfaf: Column) -> Column:
    return F.substring(pfaf.cast("long").cast("string"), 1, 5)


def mercator(lon: Column, lat: Column) -> Column:
    """Web Mercator metres."""
    r = 6378137.0
    return F.struct((F.radians(lon) * r).alias("x"), (F.ln(F.tan(F.radians(lat) / 2 + math.pi / 4)) * r).alias("y"))


def utm_zone(lon: Column) -> Column:
    return (F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1).cast("int")


def utm(lon: Column, lat: Column, zone: Column) -> Column:
    """Transverse Mercator metres on WGS 84 by Krüger's series to the third order, well below a millimetre within a zone."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    e = math.sqrt(f * (2 - f))
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, dl = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    atanh = lambda v: F.ln((1 + v) / (1 - v)) / 2
    t = F.sinh(atanh(s) - e * atanh(e * s))
    xi, eta = F.atan2(t, F.cos(dl)), atanh(F.sin(dl) / F.sqrt(1 + t * t))
    x = eta + sum(al * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, al in enumerate(alpha, 1))
    y = xi + sum(al * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, al in enumerate(alpha, 1))
    return F.struct((500000 + 0.9996 * big * x).alias("x"), (F.when(lat < 0, 1e7).otherwise(0.0) + 0.9996 * big * y).alias("y"))


def edges(rings: Column) -> Column:
    """All segments as ``struct<ax, ay, bx, by>``; each ring's last point meets its first."""

    def of_ring(r: Column) -> Column:
        return F.transform(r, lambda p, i: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), F.get(r, F.pmod(i + 1, F.size(r)))["x"].alias("bx"), F.get(r, F.pmod(i + 1, F.size(r)))["y"].alias("by")))

    return F.flatten(F.transform(rings, of_ring))


def inside(segments: Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point crosses the boundary an odd number of times."""
    crosses = lambda s: ((s["ay"] > y) != (s["by"] > y)) & (x < (s["bx"] - s["ax"]) * (y - s["ay"]) / (s["by"] - s["ay"]) + s["ax"])
    flat = lambda s: s["ay"] == s["by"]
    return F.size(F.filter(segments, lambda s: ~flat(s) & F.when(flat(s), False).otherwise(crosses(s)))) % 2 == 1


def boundary_distance(segments: Column, x: Column, y: Column) -> Column:
    """Planar distance to the nearest segment."""

    def one(s: Column) -> Column:
        dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
        size = dx * dx + dy * dy
        u = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - s["ax"]) * dx + (y - s["ay"]) * dy) / F.when(size > 0, size)))).otherwise(0.0)
        px, py = s["ax"] + u * dx - x, s["ay"] + u * dy - y
        return F.sqrt(px * px + py * py)

    return F.array_min(F.transform(segments, one))


def bounds(segments: Column) -> Column:
    low, high = lambda k: F.array_min(F.transform(segments, lambda s: s[k])), lambda k: F.array_max(F.transform(segments, lambda s: s[k]))
    return F.struct(low("ax").alias("minx"), low("ay").alias("miny"), high("ax").alias("maxx"), high("ay").alias("maxy"))


def overlap(a: Column, b: Column) -> Column:
    return (a["minx"] <= b["maxx"]) & (b["minx"] <= a["maxx"]) & (a["miny"] <= b["maxy"]) & (b["miny"] <= a["maxy"])


def centroid(segments: Column) -> Column:
    """Area-weighted centroid of rings that don't overlap; ``area`` is signed by orientation."""
    start = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, s: Column) -> Column:
        c = s["ax"] * s["by"] - s["bx"] * s["ay"]
        return F.struct((acc["a"] + c / 2).alias("a"), (acc["x"] + (s["ax"] + s["bx"]) * c / 6).alias("x"), (acc["y"] + (s["ay"] + s["by"]) * c / 6).alias("y"))

    return F.aggregate(segments, start, add, lambda t: F.struct((t["x"] / t["a"]).alias("x"), (t["y"] / t["a"]).alias("y"), t["a"].alias("area")))
