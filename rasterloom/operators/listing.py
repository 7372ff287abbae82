"""File listings: validity, canonical names, best files, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.keys import squeezed

# Prefixes under which exported layers arrive, and their files' stems.
RENAMED = {"S1": "S1_VV_VH", "S2_indices": "S2_NDVI_NDBI", "MERIT": "MERIT_Hydro", "Soil": "Soil", "ESA_PW": "ESA_PW", "Precipitation": "Precipitation", "SoilMoisture": "SoilMoisture"}


def valid_raster(length: Column, bands: Column, expected: Column) -> Column:
    return F.coalesce((length > 0) & (bands == expected), F.lit(False))


def broken_layers(files: DataFrame) -> DataFrame:
    """Layers of which a tile is empty, by folder: none of their tiles is used."""
    return files.groupBy("folder_name", "key").agg(F.bool_or(F.col("length") == 0).alias("broken"), F.count("*").alias("tiles"))


def layer_of(name: Column) -> Column:
    """The layer's key of a file by key or stem, dated or tiled; null for other files."""
    stem = F.regexp_replace(name, r"\.tif$", "")
    out = F.lit(None).cast("string")
    for key, s in RENAMED.items():
        out = F.when(stem.rlike(f"^(?:{key}|{s})(?:_[0-9]{{8}}_[0-9]{{8}})?(?:-[0-9]+-[0-9]+)?$"), key).otherwise(out)
    return out


def first_of(files: DataFrame, pattern: str) -> DataFrame:
    """Of each folder the first file, in order of path, that matches."""
    return files.where(F.col("name").rlike(pattern)).groupBy("folder_name").agg(F.min("name").alias("name"))


def has_words(stem: Column, words: list[str], without: tuple[str, ...] = (), any_of: tuple[str, ...] = ()) -> Column:
    ok = reduce(lambda a, w: a & squeezed(stem).contains(w), words, F.lit(True))
    ok = reduce(lambda a, w: a & ~F.lower(stem).contains(w), without, ok)
    return ok & reduce(lambda a, w: a | F.lower(stem).contains(w), any_of, F.lit(not any_of))


def by_priority(rows: DataFrame, keys: list[str], path: str, *rules: Column) -> DataFrame:
    """Of each key the path under the first rule that any of its rows meets, the least path among several."""
    rank = reduce(lambda rest, kr: F.when(kr[1], kr[0]).otherwise(rest), reversed(list(enumerate(rules))), F.lit(None).cast("int"))
    return rows.withColumn("__r", rank).where("__r IS NOT NULL").groupBy(*keys).agg(F.min(F.struct("__r", path)).alias("b")).select(*keys, F.col(f"b.{path}").alias(path), F.col("b.__r").alias("rule"))


def find_area(rows: DataFrame, keys: list[str]) -> DataFrame:
    s, no = F.col("stem"), ("_line", "_point")
    return by_priority(rows, keys, "stem", has_words(s, ["area", "interest"], no), has_words(s, ["aoi"], no))


def find_event(rows: DataFrame, keys: list[str]) -> DataFrame:
    s, no = F.col("stem"), ("_line", "_point")
    return by_priority(rows, keys, "stem", *(has_words(s, w, no) for w in (["observed", "event"], ["crisis", "event"], ["crisis", "information"])))


def find_map(rows: DataFrame, keys: list[str]) -> DataFrame:
    p = F.col("path")
    pdf = p.rlike(r"(?i)\.pdf$")
    return by_priority(rows, keys, "path", pdf & p.contains("RTP/"), pdf & p.rlike("DELINEATION|DEL"), pdf)


def to_fetch(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote files that aren't there under their own name, their canonical name or as part of a merged layer."""
    name = F.element_at(F.split("name", "/"), -1)
    have = local.select("folder_name", F.explode(F.array_distinct(F.array(F.col("name"), F.coalesce(layer_of(F.col("name")), F.col("name"))))).alias("k")).distinct()
    rows = remote.withColumn("base", name).withColumn("key", F.coalesce(layer_of(name), name))
    return rows.join(have.withColumnRenamed("k", "base"), ["folder_name", "base"], "left_anti").join(have.withColumnRenamed("k", "key"), ["folder_name", "key"], "left_anti").drop("base", "key")
