"""Queries about map texts, product pages and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import dates, keys, sensors
from rasterloom.plans import standins as T
from rasterloom.sources import documents as D


def map_date(spark, d):
    return T.map_texts(spark, d).select("id", dates.map_day(F.col("text")).alias("day"))


def map_sources(spark, d):
    x = T.map_texts(spark, d).select("id", sensors.sources(F.col("text")).alias("s"))
    return x.select("id", "s.pre_sensor", "s.pre_day", "s.pre_gsd_m", "s.pre_cloud_pct", "s.post_sensor", "s.post_day", "s.post_gsd_m", "s.post_sensor2", "s.post_day2")


def narrative(spark, d):
    """Old texts without labels: the radar sensor goes after, the optical one before."""
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    radar, optical = F.element_at(F.array(F.lit("COSMO-SkyMed"), F.lit("RADARSAT"), F.lit("TerraSAR-X")), (k % 3 + 1).cast("int")), F.element_at(F.array(F.lit("RapidEye"), F.lit("WorldView"), F.lit("Landsat")), (k % 3 + 1).cast("int"))
    text = F.concat(F.lit("Flood waters visible from a "), radar, F.lit(" image ("), day, F.lit("), 3 m resolution. The background is "), optical, F.lit(" imagery (acquired on "), day, F.lit("), 5 m GSD! Nothing else"))
    x = o.select(k.alias("id"), sensors.narrative(text).alias("s"))
    return x.select("id", F.col("s.post.sensor").alias("post_sensor"), F.col("s.post.day").alias("post_day"), F.col("s.post.gsd_m").alias("post_gsd_m"), F.col("s.pre.sensor").alias("pre_sensor"), F.col("s.pre.gsd_m").alias("pre_gsd_m"))


SPELLED = (
    ("Post-event image: R ADAR S AT 2 Data and products © MDA", "RADARSAT-2"),
    ("Sentinal-1 (2019)", "Sentinel-1"),
    ("Sentinel-2A/B 2018", "Sentinel-2A/B"),
    ("Pléiades Neo © Airbus", "Pléiades Neo"),
    ("WorlView-2", "WorldView-2"),
    ("PAZ satellite image", "PAZ"),
    ("COSMO-SkyMed SG radar image", "COSMO-SkyMed SG"),
    ("ost-event SPOT 6", "SPOT-6"),
    ("Unheard Of Imaging Machine Mark Two", "Unheard Of Imaging"),
    ("ry", ""),
    ("World Imag ery © ESRI", "World Imag ery"),
    ("image: UAV", "UAS/UAV"),
)


def spelled(spark, d):
    texts = F.array(*(F.lit(a) for a, _ in SPELLED))
    x = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.element_at(texts, (F.col("o_orderkey") % len(SPELLED) + 1).cast("int")).alias("raw"))
    return x.select("id", sensors.sensor_name(F.col("raw")).alias("name"))


def several(spark, d):
    x = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    text = F.concat(F.lit("MacDonald, Dettwiler and Associates RADARSAT-2 "), k.cast("string"), F.lit(" and Sentinel-1 x AND Landsat-8"))
    return x.select(k.alias("id"), F.array_join(sensors.several_sensors(text), "|").alias("parts"))


def products(spark, d):
    """Pages built from events: two areas, of which some products have no link."""
    e = T.table(spark, d, "events")
    k = F.col("event_id")
    prod = lambda kind, url, n: F.struct(F.lit(kind).alias("type"), (k % 3 == 0).alias("monitoring"), n.cast("int").alias("monitoringNumber"), url.alias("downloadPath"), F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("deliveryTime")).alias("version"))
    link = F.concat(F.lit("https://x.example/"), k.cast("string"), F.lit(".zip"))
    area = lambda n: F.struct(F.lit(n).alias("number"), F.concat(F.lit("Río "), F.col("event_type"), F.lit("/1")).alias("name"), F.array(prod("DEL", link, k % 5), prod("REF", F.when(k % 8 == 0, link).otherwise(""), F.lit(0))).alias("products"))
    body = F.to_json(F.struct(F.array(F.struct(F.array(area(1), area(2)).alias("aois"))).alias("results")))
    return D.products(e.select(F.concat(F.lit("EMSR"), k.cast("string")).alias("code"), body.alias("body")))


def activations(spark, d):
    """Pages with categories as objects and as text."""
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    kind = F.when(k % 3 == 0, "Flood").when(k % 3 == 1, "Wildfire").otherwise("flash flooding")
    cat = F.when(k % 2 == 0, F.to_json(F.struct(kind.alias("name")))).otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    time = F.when(k % 7 == 0, F.lit('""')).otherwise(F.concat(F.lit('"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('T10:00:00"')))
    body = F.concat(F.lit('{"next":null,"results":[{"code":"EMSR'), k.cast("string"), F.lit('","name":"n","activationTime":'), time, F.lit(',"category":'), cat, F.lit(',"countries":[{"short_name":"Italy"},"Spain"],"n_products":'), (k % 9).cast("string"), F.lit("}]}"))
    return D.activations(o.select(body.alias("body")), "1996-01-01", "1997-12-31").select("code", "day", "category", "countries", "n_products")


def html_links(spark, d):
    return D.links(T.table(spark, d, "pages"), "page_id", "html")


def carry(spark, d):
    """Each word of a document line with the last capitalised word before it."""
    x = T.table(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"<(h1|p|li|a)[ >]"), F.lit(1))).alias("pos", "tag"))
    heading = F.when(F.col("tag").isin("h1", "li"), F.col("pos"))
    return D.carried(x, "page_id", "pos", heading).where("tag IN ('p', 'a')").select("page_id", "pos", F.col("heading").cast("long").alias("heading"))


def files(spark, d):
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    tail = F.when(F.col("c_custkey") % 5 == 0, "_final.pdf").when(F.col("c_custkey") % 2 == 0, "_r1_RTP01.pdf").otherwise("_v2_vector.zip")
    x = c.select(F.col("c_custkey").alias("id"), F.concat(F.lit("EMSR"), k, F.lit("_AOI01_DEL_MONIT01"), tail).alias("name"))
    return x.withColumn("f", keys.product_file(F.col("name"))).where("f IS NOT NULL").select("id", "f.code", "f.area", "f.product")


def page_products(spark, d):
    """Links of a page grouped by product, the last of each kind."""
    c = T.table(spark, d, "orders")
    code = F.concat(F.lit("EMSR"), (F.col("o_custkey") % 50 + 100).cast("string"))
    k = F.col("o_orderkey")
    end = F.when(k % 3 == 0, "_r1_map.pdf").when(k % 3 == 1, "_v1_vector.zip").otherwise("_v1_other.zip")
    href = F.concat(F.lit("https://x.example/"), k.cast("string"), F.lit("/"), code, F.lit("_A"), (k % 4).cast("string"), F.lit("_DEL"), end, F.lit("?q=1"))
    return D.product_links(c.select(code.alias("code"), k.alias("pos"), href.alias("href")))


def suffix(spark, d):
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey")
    name = F.concat(F.lit("EMSR1_AOI01_"), F.when(k % 4 == 0, "NODATE").when(k % 4 == 1, "20201340").otherwise(F.concat(F.lit("2020"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))))
    return c.select(k.alias("id"), F.date_format(dates.suffix_day(name), "yyyyMMdd").alias("day"))


def window(spark, d):
    o = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"))
    span = dates.antecedent_days(F.col("day"), 30)
    return o.select("id", keys.stamped(F.lit("Precipitation"), F.col("day"), F.lit(30)).alias("stem"), F.size(span).alias("days"), keys.band_name("SM", F.element_at(span, 1)).alias("first_band"))


def seasonal(spark, d):
    o = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"))
    return o.select("id", F.date_format(dates.same_day(F.col("day"), dates.fallback_year(F.col("day"))), "yyyyMMdd").alias("other"), dates.event_day(F.when(F.col("id") % 3 == 0, ""), F.when(F.col("id") % 2 == 0, F.date_format("day", "yyyyMMdd"))).alias("chosen"))


def delivery(spark, d):
    e = T.table(spark, d, "events")
    iso = F.when(F.col("event_id") % 5 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.select("event_id", dates.delivery_day(iso).alias("day"))


def flood_text(spark, d):
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    text = F.concat(F.lit("Report. Event type: "), F.when(k % 3 == 0, "Flood").when(k % 3 == 1, "INUNDATION wave").otherwise("Wildfire"), F.lit(". More"))
    t = sensors.event_type(text)
    return o.select(k.alias("id"), t.alias("kind"), sensors.is_flood(t).alias("flood"))


_DAY = "strftime(o_orderdate, '%Y%m%d')"
_SPELL = "list_extract([" + ", ".join("'" + b.replace("'", "''") + "'" for _, b in SPELLED) + f"], CAST(o_orderkey % {len(SPELLED)} + 1 AS BIGINT))"

QUERIES = {
    "map_date": (map_date, f"SELECT o_orderkey AS id, {_DAY} AS day FROM orders"),
    "map_sources": (map_sources, f"""SELECT o_orderkey AS id, {T.S0} AS pre_sensor, {_DAY} AS pre_day, '2.5' AS pre_gsd_m, CAST(o_orderkey % 30 AS VARCHAR) AS pre_cloud_pct, {T.S3} AS post_sensor, {_DAY} AS post_day, '10' AS post_gsd_m,
 CASE WHEN o_orderkey % 3 = 0 THEN {T.S5} ELSE '' END AS post_sensor2, CASE WHEN o_orderkey % 3 = 0 THEN {_DAY} ELSE '' END AS post_day2 FROM orders"""),
    "map_narrative": (narrative, f"""SELECT o_orderkey AS id, list_extract(['COSMO-SkyMed', 'RADARSAT-2', 'TerraSAR-X'], CAST(o_orderkey % 3 + 1 AS BIGINT)) AS post_sensor, {_DAY} AS post_day, '3' AS post_gsd_m,
 list_extract(['RapidEye', 'WorldView', 'Landsat'], CAST(o_orderkey % 3 + 1 AS BIGINT)) AS pre_sensor, '5' AS pre_gsd_m FROM orders"""),
    "sensor_normalize": (spelled, f"SELECT o_orderkey AS id, {_SPELL} AS name FROM orders"),
    "multi_sensor_split": (several, "SELECT o_orderkey AS id, 'MacDonald, Dettwiler and Associates RADARSAT-2 ' || CAST(o_orderkey AS VARCHAR) || '|Sentinel-1 x|Landsat-8' AS parts FROM orders"),
    "json_products": (products, """WITH e AS (SELECT *, unnest([1, 2]) AS n FROM events), p AS (SELECT *, unnest(['DEL', 'REF']) AS kind FROM e)
 SELECT 'EMSR' || CAST(event_id AS VARCHAR) AS code, 'AOI0' || CAST(n AS VARCHAR) AS aoi, 'Río_' || event_type || '_1' AS aoi_name,
 CASE WHEN kind = 'DEL' AND event_id % 3 = 0 AND event_id % 5 > 0 THEN 'DEL_MONIT0' || CAST(event_id % 5 AS VARCHAR) ELSE kind || '_PRODUCT' END AS product,
 'https://x.example/' || CAST(event_id AS VARCHAR) || '.zip' AS url, strftime(ts, '%Y%m%d') AS delivered FROM p WHERE kind = 'DEL' OR event_id % 8 = 0"""),
    "activation_filter": (activations, """SELECT 'EMSR' || CAST(o_orderkey AS VARCHAR) AS code, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 3 = 0 THEN 'Flood' ELSE 'flash flooding' END AS category, 'Italy, Spain' AS countries, CAST(o_orderkey % 9 AS INTEGER) AS n_products
 FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderkey % 7 <> 0 AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'"""),
    "html_links": (html_links, """WITH x AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages) SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS href FROM x"""),
    "html_carry_forward": (carry, """WITH x AS (SELECT page_id, regexp_extract_all(html, '<(h1|p|li|a)[ >]', 1) AS l FROM pages), y AS (SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS tag FROM x),
 z AS (SELECT *, last_value(CASE WHEN tag IN ('h1', 'li') THEN pos END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM y) SELECT page_id, pos, heading FROM z WHERE tag IN ('p', 'a')"""),
    "filename_parse": (files, "SELECT c_custkey AS id, 'EMSR' || CAST(c_custkey AS VARCHAR) AS code, 'AOI01' AS area, 'DEL_MONIT01' AS product FROM customer WHERE c_custkey % 5 <> 0"),
    "page_products": (page_products, """WITH x AS (SELECT 'EMSR' || CAST(o_custkey % 50 + 100 AS VARCHAR) AS code, 'A' || CAST(o_orderkey % 4 AS VARCHAR) AS area, o_orderkey AS k,
 'https://x.example/' || CAST(o_orderkey AS VARCHAR) || '/EMSR' || CAST(o_custkey % 50 + 100 AS VARCHAR) || '_A' || CAST(o_orderkey % 4 AS VARCHAR) || '_DEL' || CASE o_orderkey % 3 WHEN 0 THEN '_r1_map.pdf' ELSE '_v1_vector.zip' END || '?q=1' AS href FROM orders WHERE o_orderkey % 3 <> 2)
 SELECT code, area, 'DEL' AS product, max_by(href, k) FILTER (k % 3 = 0) AS pdf, max_by(href, k) FILTER (k % 3 = 1) AS vector FROM x GROUP BY 1, 2"""),
    "date_suffix": (suffix, "SELECT c_custkey AS id, CASE WHEN c_custkey % 4 > 1 THEN '2020' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END AS day FROM customer"),
    "antecedent_window": (window, """SELECT o_orderkey AS id, 'Precipitation_' || strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m%d') || '_' || strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS stem, 30 AS days, 'SM_' || strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m%d') AS first_band FROM orders"""),
    "seasonal_date": (seasonal, f"""SELECT o_orderkey AS id, strftime(try_strptime(CAST(year(o_orderdate) + CASE WHEN year(o_orderdate) <= 2024 THEN 1 ELSE -1 END AS VARCHAR) || strftime(o_orderdate, '%m%d'), '%Y%m%d'), '%Y%m%d') AS other,
 CASE WHEN o_orderkey % 2 = 0 THEN {_DAY} ELSE 'NODATE' END AS chosen FROM orders"""),
    "delivery_date": (delivery, "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y%m%d') END AS day FROM events"),
    "event_type": (flood_text, "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'Flood' WHEN 1 THEN 'INUNDATION wave' ELSE 'Wildfire' END AS kind, o_orderkey % 3 < 2 AS flood FROM orders"),
}
