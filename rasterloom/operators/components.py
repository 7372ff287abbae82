"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.session import remove, work_dir


#: A node's edges are dealt over this many tasks.
SALTS = 64


def with_least(df: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with ``m``, the least ``value`` of each ``key``; a key may hold any share of the rows.

    Each key's rows are dealt by their value to ``SALTS`` shares. What meets at a key
    alone is one row for each share.
    """
    dealt = df.withColumn("share", F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int"))
    shares = dealt.groupBy(key, "share").agg(F.min(value).alias("m"))
    least = shares.groupBy(key).agg(F.min("m").alias("m"))
    return dealt.join(shares.select(key, "share").join(least, key), [key, "share"]).drop("share")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, component)`` with the smallest reachable node; nodes without edges don't appear.

    Each round is written to shared storage, so the lineage stays one round deep. A
    hub's neighbours are never gathered in one row or task: both stars are a partial
    minimum for each share of a node's edges followed by a join on node and share.
    Empty input, self loops and repeated edges are fine.
    """
    spark = edges.sparkSession

    def put(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = work_dir(spark)
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        return out, path, tuple(out.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now, path, mark = put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both, "u", "v").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        small = with_least(large, "u", "v").select(F.col("v").alias("x"), F.col("u"), "m")
        small = small.select(F.when(F.col("x") == F.col("m"), F.col("u")).otherwise(F.col("x")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        nxt, nxt_path, nxt_mark = put(small)
        remove(spark, path)
        now, path = nxt, nxt_path
        if nxt_mark == mark:
            break
        mark = nxt_mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
