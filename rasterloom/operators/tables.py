"""Keyed tables: last write wins, upserts, incremental catalogues, dense numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.session import materialize


def last_wins(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row of each key. One aggregation with partial maxima, no sort of a key's history."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.col(seq)).alias("__last")
    return rows.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__last.{c}").alias(c) for c in rest)).select(*rows.columns)


def upserted(log: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The current state of an append-only log of partial rows: for each column the last value that isn't null."""
    cols = [c for c in log.columns if c not in (*keys, seq)]
    return log.groupBy(*keys).agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in cols), F.max(seq).alias(seq))


def left_lookup(facts: DataFrame, dim: DataFrame, key: str, seq: str) -> DataFrame:
    """Facts with their key's last dimension row; Spark broadcasts the dimension where its size allows."""
    return facts.join(last_wins(dim, [key], seq).drop(seq), key, "left")


def not_yet(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't done."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def merged(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows stay as they are; new keys are added; columns of either side are kept."""
    return existing.unionByName(not_yet(new, existing, keys), allowMissingColumns=True)


def missing_layers(events: DataFrame, layers: DataFrame, present: DataFrame) -> DataFrame:
    """``folder_name, n_missing, missing_layers, core_missing`` in the registry's order.

    ``layers(ord, key, core)`` is a dimension of a few rows; ``present(folder_name, key)``
    is gathered to one set for each event, so nothing is multiplied out.
    """
    have = present.groupBy("folder_name").agg(F.collect_set("key").alias("have"))
    wanted = layers.groupBy().agg(F.array_sort(F.collect_list(F.struct("ord", "key", "core"))).alias("want"))
    rows = events.select("folder_name").distinct().join(have, "folder_name", "left").join(F.broadcast(wanted), F.lit(True))
    miss = F.filter("want", lambda w: ~F.array_contains(F.coalesce("have", F.array().cast("array<string>")), w["key"]))
    names = lambda a: F.array_join(F.transform(a, lambda w: w["key"]), ",")
    return rows.select("folder_name", F.size(miss).alias("n_missing"), names(miss).alias("missing_layers"), names(F.filter(miss, lambda w: w["core"])).alias("core_missing"))


def core_gate(report: DataFrame) -> DataFrame:
    """Events with all core layers."""
    return report.where("core_missing = ''").select("folder_name")


def any_na(cols: list[str]) -> Column:
    return reduce(lambda a, c: a | (F.coalesce(F.col(c), F.lit("")) == "NA"), cols, F.lit(False))


def needs_submission(status: Column) -> Column:
    return F.coalesce(status, F.lit("no")) == "no"


def refreshed(old: Column, valid: Column) -> Column:
    """NA is final; otherwise yes if the file is valid."""
    return F.when(old == "NA", "NA").when(F.coalesce(valid, F.lit(False)), "yes").otherwise("no")


def dense_index(rows: DataFrame, order: list[str], name: str = "patch_index") -> DataFrame:
    """0, 1, 2, ... along an order, without a single-task window: ranges are numbered each, and range totals, one row for each, are added up."""
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()).withColumn("__p", F.shiftright("__m", 33)).withColumn("__k", F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m")
    )
    sizes = placed.groupBy("__p").count()
    base = sizes.select("__p", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    return placed.join(F.broadcast(base), "__p").withColumn(name, F.col("__b") + F.col("__k")).drop("__p", "__k", "__b")


def skip_reason(downloaded: Column, pdf: Column, event_shape: Column, day: Column, reorganised: Column) -> Column:
    """The first step of an activation's acquisition that failed; null when it went through."""
    no = lambda c: F.coalesce(c, F.lit("no")) != "yes"
    return F.when(no(downloaded), "download failed").when(no(pdf), "no map").when(no(event_shape), "no event shape").when(no(day), "no date").when(no(reorganised), "not reorganised")
