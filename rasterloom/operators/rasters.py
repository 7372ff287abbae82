"""Rasters in long form: grids, resampling, mosaics, patches and their checks.

A raster is ``(event, band, row, col, value)``; nodata is null inside and a number at
the edges. Everything but the cubic kernel is joins and aggregations on pixel keys,
so a scene spreads over as many tasks as there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.config import DEFAULTS
from rasterloom.session import ship_package

# The files of a patch, with bands, pixels along a side, and whether pixels are a mask.
STACKS = {"input_10m": (5, 256, False), "input_80m": (5, 32, False), "input_160m": (2, 16, False), "input_2560m": (60, 1, False), "flood_mask": (1, 256, True)}


def patch_grid(scenes: DataFrame, size: int = 256, step: int | None = None) -> DataFrame:
    """``event, patch_number, row0, col0`` of all patches that fit entirely, row by row; ``scenes(event, w, h)``."""
    step = step or DEFAULTS.stride_m // DEFAULTS.fine_m
    starts = lambda n: F.when(n >= size, F.sequence(F.lit(0), n - size, F.lit(step))).otherwise(F.array().cast("array<int>"))
    rows, cols = starts(F.col("h").cast("int")), starts(F.col("w").cast("int"))
    cells = F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: F.struct(r.alias("row0"), c.alias("col0")))))
    return scenes.select("event", F.posexplode(cells).alias("patch_number", "x")).select("event", "patch_number", "x.row0", "x.col0")


def cut(pixels: DataFrame, factor: int = 1, size: int = 256, step: int | None = None, h: int | None = None, w: int | None = None) -> DataFrame:
    """Pixels of a stack whose pixels are ``factor`` fine ones wide, with patch and place inside it.

    With patches side by side the patch follows from the pixel by division, so nothing is
    joined; ``h`` and ``w`` bound the scene in fine pixels, beyond whose last whole patch
    pixels are dropped.
    """
    step = step or size
    if step < size:
        raise ValueError("patches may not overlap here; join with patch_grid instead")
    k = lambda c: F.floor(F.col(c) * factor / step)
    place = lambda c: (F.col(c) - F.floor(k(c) * step / factor)).cast("int")
    out = pixels.withColumn("pr", k("row")).withColumn("pc", k("col")).withColumn("r", place("row")).withColumn("c", place("col"))
    out = out.where((F.col("r") < size // factor) & (F.col("c") < size // factor))
    if h is not None:
        per = (w - size) // step + 1
        out = out.where((F.col("pr") <= (h - size) // step) & (F.col("pc") <= (w - size) // step)).withColumn("patch_number", (F.col("pr") * per + F.col("pc")).cast("int"))
    return out


def packed(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each patch and band with its pixels as an array, row by row."""
    return cells.groupBy(*keys, "band").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "c", "value"))), lambda x: x["value"]).alias("data"))


def valid_ratio(value: Column, nodata: float = DEFAULTS.nodata) -> Column:
    """Share of values that are there, as an aggregate."""
    return F.avg(F.when(value.isNull() | (value == nodata), 0.0).otherwise(1.0))


def nearest(source: DataFrame, targets: DataFrame, scale_row: float, scale_col: float) -> DataFrame:
    """For each target pixel the source pixel under its centre; ``scale`` is source pixels for each target pixel."""
    at = targets.withColumn("__r", F.floor((F.col("row") + 0.5) * scale_row)).withColumn("__c", F.floor((F.col("col") + 0.5) * scale_col))
    src = source.select("event", F.col("row").alias("__r"), F.col("col").alias("__c"), "value")
    return at.join(src, ["event", "__r", "__c"], "left").select("event", "row", "col", "value")


def average(source: DataFrame, scale_row: float, scale_col: float) -> DataFrame:
    """Area-weighted mean on a coarser grid; a source pixel adds to every target that it touches, and nulls weigh nothing."""

    def parts(c: str, scale: float) -> Column:
        lo, hi = F.col(c) / scale, (F.col(c) + 1) / scale
        first, last = F.floor(lo + 1e-9).cast("int"), F.greatest(F.ceil(hi - 1e-9).cast("int") - 1, F.floor(lo + 1e-9).cast("int"))
        return F.transform(F.sequence(first, last), lambda t: F.struct(t.alias("t"), (F.least(hi, t + 1.0) - F.greatest(lo, t.cast("double"))).alias("w")))

    rows = source.withColumn("pr", F.explode(parts("row", scale_row))).withColumn("pc", F.explode(parts("col", scale_col)))
    weight = F.col("pr.w") * F.col("pc.w")
    ok = F.col("value").isNotNull()
    return rows.groupBy("event", F.col("pr.t").alias("row"), F.col("pc.t").alias("col")).agg((F.sum(F.when(ok, F.col("value") * weight)) / F.sum(F.when(ok, weight))).alias("value"))


def cubic_kernel(d: np.ndarray) -> np.ndarray:
    """Catmull-Rom weights at distances ``d``."""
    d = np.abs(d)
    return np.where(d < 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0.0))


def cubic(tiles: DataFrame, out_size: int) -> DataFrame:
    """Cubic resampling of square tiles ``(event, tile, size, halo, data)`` to ``out_size`` pixels along a side.

    ``data`` holds the tile with ``halo`` pixels around it, row by row, NaN for nodata, so
    a tile needs no neighbour. Weights are made to sum to one over the pixels that are
    there; a target whose nearest source pixel is missing stays missing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for size, halo, data in zip(pdf["size"], pdf["halo"], pdf["data"]):
                full = size + 2 * halo
                a = np.asarray(data, float).reshape(full, full)
                at = (np.arange(out_size) + 0.5) * size / out_size - 0.5 + halo
                base = np.floor(at).astype(int)
                taps = np.clip(base[:, None] + np.arange(-1, 3), 0, full - 1)
                w = cubic_kernel(at[:, None] - (base[:, None] + np.arange(-1, 3)))
                there = ~np.isnan(a)
                m = np.zeros((out_size, full))
                np.add.at(m, (np.arange(out_size)[:, None], taps), w)
                total = m @ there @ m.T
                value = (m @ np.where(there, a, 0.0) @ m.T) / np.where(np.abs(total) > 1e-12, total, np.nan)
                near = np.clip(np.floor(at + 0.5).astype(int), 0, full - 1)
                value[~there[np.ix_(near, near)]] = np.nan
                out.append(value.ravel())
            yield pdf[["event", "tile"]].assign(data=out)

    ship_package(tiles.sparkSession)
    return tiles.select("event", "tile", "size", "halo", "data").mapInPandas(run, "event string, tile long, data array<double>")


def mosaic(tiles: DataFrame) -> DataFrame:
    """One raster from tiles on a common grid; where several overlap the first one with a value counts. ``tiles(event, ord, row, col, value)``."""
    return tiles.groupBy("event", "row", "col").agg(F.min_by("value", F.when(F.col("value").isNotNull(), F.col("ord"))).alias("value"))


def mask_areas(mask: DataFrame) -> DataFrame:
    """``event, aoi_area_km2, flooded_area_km2`` of masks on a geographic grid: ``(event, row, value, res_x, res_y, top)``."""
    lat = F.col("top") - (F.col("row") + 0.5) * F.col("res_y")
    area = F.col("res_x") * DEFAULTS.m_per_deg_lon * F.cos(F.radians(lat)) * (F.col("res_y") * DEFAULTS.m_per_deg_lat) / 1e6
    rows = mask.groupBy("event", "row", "res_x", "res_y", "top").agg(F.count("*").alias("n"), F.count_if(F.col("value") == 1).alias("wet"))
    return rows.withColumn("a", area).groupBy("event").agg(F.round(F.sum(F.col("a") * F.col("n")), 2).alias("aoi_area_km2"), F.round(F.sum(F.col("a") * F.col("wet")), 2).alias("flooded_area_km2"))


def quality_issues(files: DataFrame) -> DataFrame:
    """``event, patch, file, check, detail`` for each rule that a patch's file breaks.

    ``files(event, patch, file, bands, h, w, data)`` has a null ``data`` for a missing file;
    all five rules are evaluated in one pass and unfolded.
    """
    spec = F.create_map(*(y for k, (b, n, m) in STACKS.items() for y in (F.lit(k), F.struct(F.lit(b).alias("bands"), F.lit(n).alias("n"), F.lit(m).alias("mask")))))
    s = F.try_element_at(spec, F.col("file"))
    there = F.col("data").isNotNull()
    bad_number = F.exists("data", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    other = F.array_sort(F.array_distinct(F.filter("data", lambda v: ~v.isin(0.0, 1.0))))
    size = F.concat_ws("x", F.col("h").cast("string"), F.col("w").cast("string"))
    issue = lambda ok, check, detail: F.when(~F.coalesce(ok, F.lit(True)), F.struct(F.lit(check).alias("check"), detail.cast("string").alias("detail")))
    found = F.array(
        issue(there, "missing", F.lit("")),
        issue(~there | (F.col("bands") == s["bands"]), "band_count", F.col("bands")),
        issue(~there | ((F.col("h") == s["n"]) & (F.col("w") == s["n"])), "shape", size),
        issue(~there | ~bad_number, "nan_inf", F.lit("")),
        issue(~there | ~s["mask"] | (F.size(other) == 0), "mask_not_binary", F.array_join(F.slice(F.transform(other, lambda v: v.cast("string")), 1, 5), ",")),
    )
    return files.select("event", "patch", "file", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("i")).select("event", "patch", "file", "i.check", "i.detail")


def repaired(data: Column, mask: Column, nodata: float = DEFAULTS.nodata) -> Column:
    """Values that are not finite become 0 in masks and ``nodata`` elsewhere."""
    return F.transform(data, lambda v: F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.when(mask, 0.0).otherwise(nodata)).otherwise(v))
