"""Patches of a scene: layers resampled onto stacks of one extent, cut together at several resolutions.

Everything is joins and aggregations on pixel keys, with the event in each key, so many
scenes are built by one plan. Layers and scenes are in one coordinate system.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.config import DEFAULTS
from rasterloom.functions.geo import flow
from rasterloom.operators.rasters import valid_ratio

DAYS = 30

# Stacks with their pixel size in fine pixels, and for each band its layer, the band there, and how it is resampled.
STACKS = {
    "input_10m": (1, [("s1", 1, "cubic"), ("s1", 2, "cubic"), ("s2", 1, "cubic"), ("s2", 2, "cubic"), ("water", 1, "mask")]),
    "input_80m": (8, [("merit", 1, "cubic"), ("flow_sin", 1, "nearest"), ("flow_cos", 1, "nearest"), ("merit", 3, "cubic"), ("merit", 4, "cubic")]),
    "input_160m": (16, [("soil", 1, "cubic"), ("soil", 2, "cubic")]),
    "input_2560m": (256, [("rain", i + 1, "average") for i in range(DAYS)] + [("moisture", i + 1, "average") for i in range(DAYS)]),
    "flood_mask": (1, [("flood", 1, "mask")]),
}


def with_flow(pixels: DataFrame, layer: str = "merit", band: int = 2) -> DataFrame:
    """``pixels`` with layers ``flow_sin`` and ``flow_cos`` from direction codes, on the codes' own grid; other codes have no value."""
    codes = pixels.where((F.col("layer") == layer) & (F.col("band") == band))
    parts = [codes.withColumn("layer", F.lit(f"flow_{p}")).withColumn("band", F.lit(1)).withColumn("value", F.nullif(flow(F.col("value"))[p], F.lit(DEFAULTS.nodata))) for p in ("sin", "cos")]
    return pixels.unionByName(parts[0]).unionByName(parts[1])


def grids(scenes: DataFrame, fine: float, stacks: dict = STACKS) -> DataFrame:
    """``event, file, factor, h, w, left, top, step_x, step_y`` of each stack; ``scenes(event, minx, miny, maxx, maxy)``.

    A stack has as many whole pixels as the extent holds, stretched to fill it.
    """
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("file"), F.lit(k).alias("factor")) for n, (k, _) in stacks.items())))
    out = scenes.withColumn("s", each).select("*", "s.file", "s.factor")
    out = out.withColumn("w", F.floor((F.col("maxx") - F.col("minx")) / (fine * F.col("factor"))).cast("int")).withColumn("h", F.floor((F.col("maxy") - F.col("miny")) / (fine * F.col("factor"))).cast("int"))
    out = out.where("w > 0 AND h > 0").withColumn("step_x", (F.col("maxx") - F.col("minx")) / F.col("w")).withColumn("step_y", (F.col("maxy") - F.col("miny")) / F.col("h"))
    return out.select("event", "file", "factor", "h", "w", F.col("minx").alias("left"), F.col("maxy").alias("top"), "step_x", "step_y")


def _bands(stacks: dict) -> Column:
    slots = [(n, i + 1, *b) for n, (_, bands) in stacks.items() for i, b in enumerate(bands)]
    return F.explode(F.array(*(F.struct(F.lit(f).alias("file"), F.lit(i).alias("slot"), F.lit(layer).alias("layer"), F.lit(b).alias("band"), F.lit(m).alias("method")) for f, i, layer, b, m in slots)))


def _cells(jobs: DataFrame) -> DataFrame:
    """A row for each pixel of each job; rows of pixels are dealt over tasks before columns are made."""
    rows = jobs.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("h") - 1))).repartition("event", "file", "slot", "row")
    return rows.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("w") - 1)))


def _weight(d: Column) -> Column:
    a = F.abs(d)
    return F.when(a < 1, 1.5 * a * a * a - 2.5 * a * a + 1).when(a < 2, -0.5 * a * a * a + 2.5 * a * a - 4 * a + 2).otherwise(0.0)


def resampled(pixels: DataFrame, places: DataFrame, grid: DataFrame, stacks: dict = STACKS) -> DataFrame:
    """``event, file, slot, row, col, value`` of the pixels of stacks that have a value.

    ``pixels(event, layer, band, row, col, value)`` are null where there is no data;
    ``places(event, layer, minx, maxy, res_x, res_y)``. Cubic weights sum to one over the
    pixels that are there, and a pixel whose nearest one is missing stays missing.
    """
    bands = places.select("event").distinct().withColumn("b", _bands(stacks)).select("event", "b.*")
    jobs = bands.join(places, ["event", "layer"]).join(grid, ["event", "file"])
    src = pixels.where("value IS NOT NULL")
    x = (F.col("left") + (F.col("col") + 0.5) * F.col("step_x") - F.col("minx")) / F.col("res_x")
    y = (F.col("maxy") - (F.col("top") - (F.col("row") + 0.5) * F.col("step_y"))) / F.col("res_y")
    key, out = ["event", "file", "slot", "row", "col"], ["event", "file", "slot", "row", "col", "value"]
    source = src.select("event", "layer", "band", F.col("row").alias("r"), F.col("col").alias("c"), "value")
    near = _cells(jobs.where("method IN ('nearest', 'mask')")).withColumn("r", F.floor(y).cast("int")).withColumn("c", F.floor(x).cast("int"))
    near = near.join(source, ["event", "layer", "band", "r", "c"]).select(*out)
    at = _cells(jobs.where("method = 'cubic'")).withColumn("x", x).withColumn("y", y)
    taps = at.withColumn("r", F.explode(F.sequence(F.floor(F.col("y") - 0.5).cast("int") - 1, F.floor(F.col("y") - 0.5).cast("int") + 2)))
    taps = taps.withColumn("c", F.explode(F.sequence(F.floor(F.col("x") - 0.5).cast("int") - 1, F.floor(F.col("x") - 0.5).cast("int") + 2)))
    taps = taps.withColumn("k", _weight(F.col("y") - 0.5 - F.col("r")) * _weight(F.col("x") - 0.5 - F.col("c")))
    nearest = (F.col("r") == F.floor("y")) & (F.col("c") == F.floor("x"))
    cubic = taps.join(source, ["event", "layer", "band", "r", "c"]).groupBy(*key).agg(F.sum(F.col("k") * F.col("value")).alias("s"), F.sum("k").alias("k"), F.max(nearest).alias("there"))
    cubic = cubic.where(F.col("there") & (F.abs("k") > 1e-12)).select(*key, (F.col("s") / F.col("k")).alias("value"))

    def parts(lo: Column, hi: Column, n: str) -> Column:
        first, last = F.greatest(F.floor(lo + 1e-9), F.lit(0)).cast("int"), F.least(F.ceil(hi - 1e-9) - 1, F.col(n) - 1).cast("int")
        steps = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.explode(F.transform(steps, lambda t: F.struct(t.alias("t"), (F.least(hi, t + 1.0) - F.greatest(lo, t.cast("double"))).alias("w"))))

    mean = src.join(jobs.where("method = 'average'"), ["event", "layer", "band"])
    top, left = (F.col("top") - F.col("maxy")) / F.col("step_y"), (F.col("minx") - F.col("left")) / F.col("step_x")
    high, wide = F.col("res_y") / F.col("step_y"), F.col("res_x") / F.col("step_x")
    mean = mean.withColumn("pr", parts(top + F.col("row") * high, top + (F.col("row") + 1) * high, "h")).withColumn("pc", parts(left + F.col("col") * wide, left + (F.col("col") + 1) * wide, "w"))
    weight = F.col("pr.w") * F.col("pc.w")
    mean = mean.groupBy("event", "file", "slot", F.col("pr.t").alias("row"), F.col("pc.t").alias("col")).agg((F.sum(F.col("value") * weight) / F.sum(weight)).alias("value"))
    return near.unionByName(cubic).unionByName(mean)


def stacked(pixels: DataFrame, places: DataFrame, grid: DataFrame, stacks: dict = STACKS, nodata: float = DEFAULTS.nodata) -> DataFrame:
    """Every pixel of every band of every stack, with its ``grid``: masks are 0 or 1 and 0 where nothing is known, others ``nodata``."""
    jobs = grid.select("event").distinct().withColumn("b", _bands(stacks)).select("event", "b.file", "b.slot", "b.method").join(grid, ["event", "file"])
    all_cells = _cells(jobs).join(resampled(pixels, places, grid, stacks), ["event", "file", "slot", "row", "col"], "left")
    value = F.when(F.col("method") == "mask", (F.coalesce("value", F.lit(0.0)) > 0).cast("double")).otherwise(F.coalesce("value", F.lit(nodata)))
    return all_cells.withColumn("value", value)


def cut_stacks(cells: DataFrame, grid: DataFrame, fine_file: str = "input_10m", size: int = 256, step: int | None = None) -> DataFrame:
    """``cells`` with ``patch_number, row0, col0, r, c``: patches of ``size`` fine pixels every ``step``, which may overlap.

    Patches are numbered row by row over all that fit in the stack ``fine_file``. A coarse
    stack begins at the patch's origin divided without remainder.
    """
    step = step or DEFAULTS.stride_m // DEFAULTS.fine_m
    fits = grid.where((F.col("file") == fine_file) & (F.col("h") >= size) & (F.col("w") >= size))
    fits = fits.select("event", F.floor((F.col("h") - size) / step).cast("int").alias("last_r"), F.floor((F.col("w") - size) / step).cast("int").alias("last_c"))

    def origins(at: str, last: str) -> Column:
        lo = F.greatest(F.floor((F.col(at) * F.col("factor") - size) / step), F.lit(0)).cast("int")
        hi = F.least(F.floor(((F.col(at) + 1) * F.col("factor") - 1) / step), F.col(last)).cast("int")
        place = lambda k: F.col(at) - F.floor(k * step / F.col("factor"))
        ks = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        return F.explode(F.filter(ks, lambda k: (place(k) >= 0) & (place(k) < F.lit(size) / F.col("factor"))))

    out = cells.join(fits, "event").withColumn("kr", origins("row", "last_r")).withColumn("kc", origins("col", "last_c"))
    out = out.withColumn("patch_number", F.col("kr") * (F.col("last_c") + 1) + F.col("kc")).withColumn("row0", F.col("kr") * step).withColumn("col0", F.col("kc") * step)
    place = lambda at, origin: (F.col(at) - F.floor(F.col(origin) / F.col("factor"))).cast("int")
    return out.withColumn("r", place("row", "row0")).withColumn("c", place("col", "col0")).drop("kr", "kc", "last_r", "last_c")


def kept(cells: DataFrame, fine_file: str = "input_10m", least: float = DEFAULTS.least_valid, nodata: float = DEFAULTS.nodata) -> DataFrame:
    """The cells of patches of which at least a share ``least`` of the fine stack's values, all bands together, is there."""
    share = cells.where(F.col("file") == fine_file).groupBy("event", "patch_number").agg(valid_ratio(F.col("value"), nodata).alias("share"))
    return cells.join(share.where(F.col("share") >= least).select("event", "patch_number"), ["event", "patch_number"], "left_semi")


def patch_files(cells: DataFrame, nodata: float = DEFAULTS.nodata, mask_file: str = "flood_mask") -> DataFrame:
    """One row for each patch and file, as the ``raster`` sink takes them; ``data`` is band by band, row by row."""
    data = F.transform(F.array_sort(F.collect_list(F.struct("slot", "r", "c", "value"))), lambda v: v["value"])
    place = ["event", "patch_number", "file", "factor", "row0", "col0", "left", "top", "step_x", "step_y"]
    out = cells.groupBy(*place).agg(F.max("slot").alias("bands"), (F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"), data.alias("data"))
    name = F.format_string("%s/patch_%04d_%s", F.col("event"), F.col("patch_number"), F.col("file"))
    # A file lies where its cut says: a coarse one at the divided origin of its own grid.
    minx, maxy = F.col("left") + F.floor(F.col("col0") / F.col("factor")) * F.col("step_x"), F.col("top") - F.floor(F.col("row0") / F.col("factor")) * F.col("step_y")
    return out.select("event", "patch_number", "file", name.alias("name"), "bands", "h", "w", minx.alias("minx"), maxy.alias("maxy"), F.col("step_x").alias("res_x"), F.col("step_y").alias("res_y"), F.lit(nodata).alias("nodata"), (F.col("file") == mask_file).alias("mask"), "data")


def patch_metadata(cells: DataFrame, mask_file: str = "flood_mask", size: int = 256) -> DataFrame:
    """``event, patch_number, bounds_minx, bounds_miny, bounds_maxx, bounds_maxy, flood_pixels``; the mask's pixels are fine ones."""
    minx, maxy = F.col("left") + F.col("col0") * F.col("step_x"), F.col("top") - F.col("row0") * F.col("step_y")
    bounds = [minx.alias("bounds_minx"), (maxy - size * F.col("step_y")).alias("bounds_miny"), (minx + size * F.col("step_x")).alias("bounds_maxx"), maxy.alias("bounds_maxy")]
    flooded = F.count_if(F.col("value") == 1).alias("flood_pixels")
    return cells.where(F.col("file") == mask_file).select("event", "patch_number", *bounds, "value").groupBy("event", "patch_number", "bounds_minx", "bounds_miny", "bounds_maxx", "bounds_maxy").agg(flooded)
