"""The engine's tables derived from the driver's, alike in Spark and in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.functions import geo

SENSORS = ("RADARSAT-2", "Sentinel-1A", "Sentinel-2B", "COSMO-SkyMed", "Landsat-8", "WorldView-2", "TerraSAR-X", "RapidEye")
POLYGONS = {
    1: [[(-100.0, -40.0), (20.0, -40.0), (20.0, 50.0), (-100.0, 50.0)], [(-50.0, -10.0), (-20.0, -10.0), (-20.0, 20.0), (-50.0, 20.0)]],
    2: [[(30.0, 0.0), (120.0, 10.0), (90.0, 70.0), (40.0, 60.0)]],
    3: [[(-170.0, 55.0), (-110.0, 60.0), (-140.0, 80.0)]],
    4: [[(0.0, -85.0), (150.0, -80.0), (150.0, -45.0), (60.0, -55.0), (0.0, -60.0)]],
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def folder(c) -> F.Column:
    return F.concat(F.lit("EVT"), F.lpad(c.cast("string"), 6, "0"))


def events(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    total = c.agg(F.count("*").alias("total"))
    k = F.col("c_custkey")
    basin = F.concat(F.floor(k / 5).cast("string"), F.when(k % 10 == 3, F.concat(F.lit("-"), F.floor((k * 7) % F.col("total") / 5).cast("string"))).otherwise(""))
    x = c.join(F.broadcast(total), F.lit(True)).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.select(k.alias("id"), folder(k).alias("folder_name"), basin.alias("basin_id"), F.col("r_name").alias("continent"), F.col("c_mktsegment").alias("climate"), F.abs("c_acctbal").alias("aoi_area_km2"))


EV = """ev AS (SELECT c_custkey AS id, 'EVT' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS folder_name,
  CAST(c_custkey // 5 AS VARCHAR) || CASE WHEN c_custkey % 10 = 3 THEN '-' || CAST(((c_custkey * 7) % (SELECT count(*) FROM customer)) // 5 AS VARCHAR) ELSE '' END AS basin_id,
  r_name AS continent, c_mktsegment AS climate, abs(c_acctbal) AS aoi_area_km2
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def patches(spark: SparkSession, d: str) -> DataFrame:
    """``patch_index`` follows event and order key; here both are numbers, and the index is their rank by running totals of events."""
    o = table(spark, d, "orders")
    number = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    sizes = o.groupBy("o_custkey").agg(F.count("*").alias("n"))
    # Running totals in two steps: within blocks of a thousand events, then over the blocks.
    block = F.floor(F.col("o_custkey") / 1000)
    within = F.sum("n").over(Window.partitionBy("blk").orderBy("o_custkey").rowsBetween(Window.unboundedPreceding, -1))
    sized = sizes.withColumn("blk", block)
    blocks = sized.groupBy("blk").agg(F.sum("n").alias("bn")).withColumn("before", F.coalesce(F.sum("bn").over(Window.orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    base = sized.withColumn("w", F.coalesce(within, F.lit(0))).join(F.broadcast(blocks.select("blk", "before")), "blk").select("o_custkey", (F.col("before") + F.col("w")).alias("base"))
    rows = o.withColumn("patch_number", number).join(base, "o_custkey")
    cls = F.substring("o_orderpriority", 1, 1)
    res = F.when(cls == "1", "very-high").when(cls == "2", "high").when(cls == "3", "medium").otherwise("unknown")
    p = rows.select(
        "o_custkey",
        folder(F.col("o_custkey")).alias("folder_name"),
        "o_orderkey",
        F.col("patch_number").cast("long").alias("patch_number"),
        (F.col("base") + F.col("patch_number")).alias("patch_index"),
        (F.floor("o_totalprice").cast("long") % 65537).alias("flood_pixels"),
        res.alias("resolution_class"),
    )
    return p.join(events(spark, d).select("folder_name", "basin_id", "continent", "climate"), "folder_name")


PT = """pt AS (SELECT o_custkey, 'EVT' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS folder_name, o_orderkey,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS patch_number,
  row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS patch_index,
  CAST(floor(o_totalprice) AS BIGINT) % 65537 AS flood_pixels,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'very-high' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' ELSE 'unknown' END AS resolution_class,
  ev.basin_id, ev.continent, ev.climate
  FROM orders JOIN ev ON ev.id = o_custkey)"""
#: A split by event number, where a query is about the split's tables and not its making.
SPLIT_SQL = "CASE WHEN o_custkey % 20 < 14 THEN 'train' WHEN o_custkey % 20 < 17 THEN 'val' ELSE 'test' END"


def split_patches(spark: SparkSession, d: str) -> DataFrame:
    return patches(spark, d).withColumn("split", F.expr(SPLIT_SQL))


def acquisitions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    kind = F.col("event_type")
    pol = F.when(kind.isin("click", "view"), F.array(F.lit("VV"), F.lit("VH"))).otherwise(F.array(F.lit("VV")))
    return e.select(F.col("user_id").alias("pixel"), F.col("ts").cast("timestamp").alias("ts"), "value", F.when(kind == "error", "EW").otherwise("IW").alias("mode"), pol.alias("polarisations"), F.get_json_object("props", "$.k").cast("int").alias("cloud_pct"), "event_id")


AQ = """aq AS (SELECT user_id AS pixel, ts, value, CASE WHEN event_type = 'error' THEN 'EW' ELSE 'IW' END AS mode,
  event_type IN ('click', 'view') AS dual, CAST(json_extract_string(props, '$.k') AS INTEGER) AS cloud_pct, event_id FROM events)"""


def pixels(spark: SparkSession, d: str) -> DataFrame:
    return acquisitions(spark, d).select("pixel").distinct().withColumn("area", (1 + F.col("pixel") % 7).cast("double"))


PX = "px AS (SELECT DISTINCT pixel, CAST(1 + pixel % 7 AS DOUBLE) AS area FROM aq)"
#: The event's day for series and composites; the observations are of the days around it.
EVENT_DAY = "2024-01-20"
#: Days of many events, which share the observations.
EVENT_DAYS = {"A": "2024-01-20", "B": "2024-01-11", "C": "2024-01-28"}


def event_days(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EVENT_DAYS.items()), "event string, day string").withColumn("day", F.to_date("day"))


def of_each_event(df: DataFrame) -> DataFrame:
    return df.withColumn("event", F.explode(F.array(*map(F.lit, EVENT_DAYS))))


def sql_of_each_event(sql: str) -> str:
    """A query about the one event, for each event."""
    return " UNION ALL ".join(f"SELECT '{e}' AS event, x.* FROM ({sql.replace(EVENT_DAY, day)}) AS x" for e, day in EVENT_DAYS.items())


def raster(spark: SparkSession, d: str) -> DataFrame:
    """A 64 x 64 scene for each line status; the value is missing where the discount is 0."""
    x = table(spark, d, "lineitem")
    return x.groupBy(F.col("l_linestatus").alias("event"), (F.col("l_partkey") % 64).cast("int").alias("row"), (F.col("l_suppkey") % 64).cast("int").alias("col")).agg(F.max(F.when(F.col("l_discount") > 0, F.col("l_extendedprice"))).alias("value"))


RS = """rs AS (SELECT l_linestatus AS event, CAST(l_partkey % 64 AS INTEGER) AS "row", CAST(l_suppkey % 64 AS INTEGER) AS col,
  max(CASE WHEN l_discount > 0 THEN l_extendedprice END) AS value FROM lineitem GROUP BY 1, 2, 3)"""


def polygons(spark: SparkSession, only=None) -> DataFrame:
    rows = [(k, [[(float(x), float(y)) for x, y in r] for r in rings]) for k, rings in POLYGONS.items() if only is None or k in only]
    return spark.createDataFrame(rows, f"poly_id long, rings {geo.RINGS}")


def _segments() -> str:
    rows = []
    for k, rings in POLYGONS.items():
        for r in rings:
            for (ax, ay), (bx, by) in zip(r, [*r[1:], r[0]]):
                rows.append(f"({k}, {ax}::DOUBLE, {ay}::DOUBLE, {bx}::DOUBLE, {by}::DOUBLE)")
    return "seg(poly_id, ax, ay, bx, by) AS (VALUES " + ", ".join(rows) + ")"


SEG = _segments()


def points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("pid"), ((k * 37) % 360 - 179.75).alias("x"), ((k * 17) % 180 - 89.75).alias("y"))


PTS = "pts AS (SELECT c_custkey AS pid, CAST((c_custkey * 37) % 360 AS DOUBLE) - 179.75 AS x, CAST((c_custkey * 17) % 180 AS DOUBLE) - 89.75 AS y FROM customer)"


def map_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of three eras, with the day and sensors that they name."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    name = lambda shift: F.element_at(F.array(*map(F.lit, SENSORS)), ((k + shift) % 8 + 1).cast("int"))
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    head = F.when(k % 4 == 0, F.concat(F.lit("Map | Situation as of "), day)).when(k % 4 == 1, F.concat(F.lit("Karte | Stand vom "), F.date_format("o_orderdate", "dd.MM.yyyy"))).when(k % 4 == 2, F.concat(F.lit("Flood - "), day)).otherwise(F.concat(F.lit("issued "), day, F.lit(" in print")))
    src = F.concat(
        F.lit(" | Data sources and analysis: Pre-event image: "), name(0), F.lit(" © Agency (acquired on "), day, F.lit(", GSD 2,5 m, approx. "), (k % 30).cast("string"), F.lit("% cloud coverage). Post-event image: "),
        name(3), F.lit(" (acquired on "), day, F.lit(", resolution 10 m)"), F.when(k % 3 == 0, F.concat(F.lit(" and "), name(5), F.lit(" (a cquired on "), day, F.lit(")"))).otherwise(""), F.lit(" Base vector layers: none"),
    )
    return o.select(k.alias("id"), F.concat(head, src).alias("text"), F.date_format("o_orderdate", "yyyyMMdd").alias("day"))


def _sensor_sql(shift: int) -> str:
    return f"list_extract([{', '.join(repr(s) for s in SENSORS)}], CAST((o_orderkey + {shift}) % 8 + 1 AS BIGINT))"


S0, S3, S5 = (_sensor_sql(k) for k in (0, 3, 5))


def listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of each event's layers, some absent, some empty, some of a wrong band count."""
    ev = events(spark, d).select("id", "folder_name")
    x = ev.withColumn("ord", F.explode(F.sequence(F.lit(0), F.lit(6)))).where((F.col("id") * 7 + F.col("ord") * 3) % 11 > 1)
    key = F.element_at(F.array(*map(F.lit, KEYS)), F.col("ord") + 1)
    return x.select("folder_name", "id", "ord", key.alias("key"), F.concat(key, F.lit(".tif")).alias("name"), F.when((F.col("id") + F.col("ord")) % 13 == 0, 0).otherwise(1000 + F.col("id")).cast("long").alias("length"), F.when((F.col("id") + F.col("ord")) % 17 == 0, 1).otherwise(2).alias("bands"))


KEYS = ("S1", "S2_indices", "MERIT", "Soil", "ESA_PW", "Precipitation", "SoilMoisture")
LS = f"""ls AS (SELECT folder_name, id, ord, list_extract([{", ".join(repr(k) for k in KEYS)}], ord + 1) AS key,
  list_extract([{", ".join(repr(k) for k in KEYS)}], ord + 1) || '.tif' AS name,
  CAST(CASE WHEN (id + ord) % 13 = 0 THEN 0 ELSE 1000 + id END AS BIGINT) AS length, CASE WHEN (id + ord) % 17 = 0 THEN 1 ELSE 2 END AS bands
  FROM ev, (SELECT unnest(range(7)) AS ord) WHERE (id * 7 + ord * 3) % 11 > 1)"""
