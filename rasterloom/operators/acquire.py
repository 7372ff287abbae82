"""Work lists: which activations, from which source, which layers to request on which grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.config import DEFAULTS
from rasterloom.functions import dates, geo, keys
from rasterloom.operators.tables import not_yet

# Pixels in degrees of the layers whose native grid isn't metres divided by 111 km.
NATIVE_DEG = {"Precipitation": 0.1, "SoilMoisture": 0.09516}


def in_scope(folder: Column, first_year: int = DEFAULTS.first_year) -> Column:
    """Events from the first year on; those without a date pass."""
    day = dates.suffix_day(folder)
    return day.isNull() | (F.year(day) >= first_year)


def route(code: Column, first: int = DEFAULTS.api_from_code) -> Column:
    """Newer codes are served by the interface, older ones by pages."""
    return F.when(keys.code_number(code) >= first, "api").otherwise("html")


def routed(codes: DataFrame, code: str, api: DataFrame, html: DataFrame) -> DataFrame:
    """Products of each code from the source that serves it."""
    want = codes.select(F.col(code).alias("code"), route(F.col(code)).alias("__r"))
    side = lambda rows, name: rows.join(want.where(F.col("__r") == name).select("code"), "code", "left_semi")
    return side(api, "api").unionByName(side(html, "html"), allowMissingColumns=True)


def event_kind(*found: Column) -> Column:
    """The first source that names an event's type."""
    return F.coalesce(*(keys.blank_to_null(c) for c in found))


def joined_sensors(*names: Column) -> Column:
    """Sensors that aren't blank, joined by commas."""
    return F.concat_ws(", ", *(keys.blank_to_null(c) for c in names))


def flooded_only(events: DataFrame, shapes: DataFrame) -> DataFrame:
    """Events with a flood outline among the files."""
    return events.join(shapes.select("folder_name").distinct(), "folder_name", "left_semi")


def pixel_deg(layer: Column, kind: Column, metres: Column) -> Column:
    """Composites, and static layers of the same pixel, are on the fine grid; others on their own."""
    fine = (kind == "composite") | ((kind == "static") & (metres == DEFAULTS.fine_m))
    own = reduce(lambda rest, kv: F.when(layer == kv[0], F.lit(kv[1])).otherwise(rest), NATIVE_DEG.items(), geo.degrees(metres))
    return F.when(fine, F.lit(DEFAULTS.fine_deg)).otherwise(own)


def requests(events: DataFrame, layers: DataFrame, status: DataFrame) -> DataFrame:
    """One row for each layer of each event that is still to be requested: ``folder_name, key, file, pixel, minx, miny, maxx, maxy, task``.

    ``events(folder_name, minx, miny, maxx, maxy)``, ``layers`` as the registry frames them,
    ``status(folder_name, key, state)``. An event with any layer that is marked NA is left
    alone. The registry's few rows are unfolded beside each event.
    """
    barred = status.where("state = 'NA'").select("folder_name").distinct()
    rows = events.where(in_scope(F.col("folder_name"))).join(barred, "folder_name", "left_anti")
    spec = layers.groupBy().agg(F.array_sort(F.collect_list(F.struct("ord", "key", "stem", "kind", "resolution_m", "n_days", "buffered"))).alias("l"))
    rows = rows.join(F.broadcast(spec), F.lit(True)).withColumn("l", F.explode("l"))
    rows = rows.join(status.where("state <> 'no'").select("folder_name", F.col("key").alias("__k")), (rows["folder_name"] == status["folder_name"]) & (F.col("l.key") == F.col("__k")), "left_anti")
    pixel = pixel_deg(F.col("l.key"), F.col("l.kind"), F.col("l.resolution_m"))
    box = F.struct("minx", "miny", "maxx", "maxy")
    wide = geo.buffered(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    rows = rows.withColumn("b", F.when(F.col("l.buffered"), wide).otherwise(box)).withColumn("pixel", pixel)
    day = dates.suffix_day(F.col("folder_name"))
    file = F.when((F.col("l.kind") == "temporal") & day.isNotNull(), keys.stamped(F.col("l.stem"), day, F.col("l.n_days"))).otherwise(F.col("l.stem"))
    s = geo.snapped(F.col("b.minx"), F.col("b.miny"), F.col("b.maxx"), F.col("b.maxy"), F.col("pixel"))
    return rows.select("folder_name", "l.key", file.alias("file"), "pixel", s.alias("s"), keys.task_name(F.concat_ws("_", "folder_name", "l.key"), 100).alias("task")).select("folder_name", "key", "file", "pixel", "s.minx", "s.miny", "s.maxx", "s.maxy", "task")


def append_once(new: DataFrame, store: str, key: list[str]) -> int:
    """Append rows whose key the Parquet store doesn't have yet; how many there were."""
    spark = new.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    there = root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)
    fresh = not_yet(new, spark.read.parquet(store), key) if there else new
    fresh = fresh.dropDuplicates(key).cache()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(store)
    fresh.unpersist()
    return n


def regions(parts: list[DataFrame]) -> DataFrame:
    """Regional layers as one, whatever columns each has."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
