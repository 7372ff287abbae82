"""Queries about lookups, gates, status tables, listings and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import geo, keys, sensors
from rasterloom.operators import acquire as A
from rasterloom.operators import listing as L
from rasterloom.operators import tables as B
from rasterloom.plans import standins as T
from rasterloom.registry import Registry


def _sensor(k, shift=0):
    return F.element_at(F.array(*map(F.lit, T.SENSORS)), ((k + shift) % 8 + 1).cast("int"))


def left_lookup(spark, d):
    o = T.table(spark, d, "orders")
    dim = o.select(T.folder(F.col("o_custkey")).alias("folder_name"), F.col("o_orderkey").alias("seq"), _sensor(F.col("o_orderkey")).alias("sensor"))
    return B.left_lookup(T.events(spark, d).select("folder_name", "continent"), dim, "folder_name", "seq")


def _old(spark, d):
    return T.events(spark, d).where("id % 3 = 0").select("folder_name", "basin_id", F.lit("train").alias("split"))


def _new(spark, d):
    return T.events(spark, d).where("id % 2 = 0").select("folder_name", "basin_id", "continent")


def new_events(spark, d):
    return B.not_yet(_new(spark, d), _old(spark, d), ["folder_name"])


def merge(spark, d):
    return B.merged(_old(spark, d), _new(spark, d), ["folder_name"])


def missing(spark, d):
    return B.missing_layers(T.events(spark, d), Registry().frame(spark), T.listing(spark, d))


def gate(spark, d):
    """Events with all core layers, the precipitation layer counting as a custom one."""
    layers = Registry().frame(spark).withColumn("core", F.col("key") != "Precipitation")
    return B.core_gate(B.missing_layers(T.events(spark, d), layers, T.listing(spark, d)))


def _log(spark, d):
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        T.folder(F.col("o_custkey")).alias("folder_name"),
        k.alias("seq"),
        F.when(k % 3 == 0, F.when(k % 2 == 0, "yes").otherwise("no")).alias("S1"),
        F.when(k % 5 == 0, F.when(k % 7 == 0, "NA").otherwise("yes")).alias("MERIT"),
    )


_LOG = """lg AS (SELECT 'EVT' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS folder_name, o_orderkey AS seq,
  CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END END AS "S1",
  CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE 'yes' END END AS "MERIT" FROM orders),
cur AS (SELECT folder_name, max_by("S1", seq) FILTER ("S1" IS NOT NULL) AS "S1", max_by("MERIT", seq) FILTER ("MERIT" IS NOT NULL) AS "MERIT", max(seq) AS seq FROM lg GROUP BY 1)"""


def upsert(spark, d):
    return B.upserted(_log(spark, d), ["folder_name"], "seq")


def na_gate(spark, d):
    now = upsert(spark, d)
    return now.where(~B.any_na(["S1", "MERIT"])).where(B.needs_submission(F.col("S1")) | B.needs_submission(F.col("MERIT"))).select("folder_name")


def refresh(spark, d):
    """Status after a new look at the files: NA stays, valid files are yes."""
    files = T.listing(spark, d).where("key = 'S1'").select("folder_name", L.valid_raster(F.col("length"), F.col("bands"), F.lit(2)).alias("ok"))
    return upsert(spark, d).join(files, "folder_name", "left").select("folder_name", B.refreshed(F.col("MERIT"), F.col("ok")).alias("status"))


def last_row(spark, d):
    return B.last_wins(_log(spark, d), ["folder_name"], "seq")


def dense(spark, d):
    p = T.patches(spark, d).where("flood_pixels % 3 <> 0").select("o_custkey", "o_orderkey", "patch_number")
    return B.dense_index(p, ["o_custkey", "o_orderkey"], "idx")


def resolution(spark, d):
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    listed = F.concat_ws(", ", _sensor(k), F.when(k % 3 == 0, _sensor(k, 3)), F.when(k % 5 == 0, F.lit("Unknown-9")))
    x = o.select(k.alias("id"), F.when(k % 11 == 0, "").otherwise(listed).alias("sensors"))
    m = sensors.finest(F.col("sensors"))
    return x.select("id", "sensors", m.alias("metres"), sensors.resolution_class(m).alias("cls"))


_METRES = "CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in sensors.METRES.items() if k in T.SENSORS) + " END"


def climate(spark, d):
    v = (F.col("o_orderkey") % 33 - 1).cast("int")
    c = geo.climate_class(F.col("v"))
    return T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), v.alias("v")).select("id", "v", c.alias("letter"), geo.climate_label(c).alias("label"))


def continents(spark, d):
    names = F.array(*map(F.lit, ("Asia", "Oceania", "Europe", "Antarctica")))
    p = T.points(spark, d).withColumn("name", F.element_at(names, (F.col("pid") % 4 + 1).cast("int")))
    return p.select("pid", geo.continent_label(F.col("name"), F.col("x"), F.col("y")).alias("label"))


def basins(spark, d):
    return T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), geo.basin_l5((F.col("o_orderkey") * 7919 + 230000000).cast("double")).alias("l5"))


def size_bins(spark, d):
    from rasterloom.operators.split import size_bin

    return T.events(spark, d).groupBy(size_bin(F.col("aoi_area_km2")).alias("bin")).agg(F.count("*").alias("n"))


def validity(spark, d):
    f = T.listing(spark, d)
    return f.groupBy("key").agg(F.count_if(L.valid_raster(F.col("length"), F.col("bands"), F.lit(2))).alias("valid"), F.count("*").alias("files"))


def broken(spark, d):
    return L.broken_layers(T.listing(spark, d)).where("broken").groupBy("key").agg(F.count("*").alias("layers"), F.sum("tiles").alias("tiles"))


def _stem(key):
    return F.element_at(F.create_map(*(F.lit(x) for kv in L.RENAMED.items() for x in kv)), key)


def difference(spark, d):
    files = T.listing(spark, d)
    local = files.where("id % 2 = 0").select("folder_name", "name")
    remote = files.select("folder_name", F.concat(F.lit("drive/"), _stem(F.col("key")), F.lit("-0000000000-0000000256.tif")).alias("name"))
    return L.to_fetch(remote, local)


def best_file(spark, d):
    rows = T.events(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    stems = F.array(F.lit("EMSR_Observed_Event_A"), F.lit("crisis_information_poly"), F.lit("ObservedEvent_line"), F.lit("crisisEventA"))
    x = rows.where((F.col("id") + F.col("k")) % 3 != 0).select("folder_name", F.concat(F.element_at(stems, F.col("k") + 1), F.lit("_"), (F.col("id") % 4).cast("string")).alias("stem"))
    return L.find_event(x, ["folder_name"])


def names(spark, d):
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey")
    label = keys.product_label(F.lit("DEL"), k % 2 == 0, (k % 5).cast("int"))
    code = F.concat(F.lit("EMSR"), (k + 100).cast("string"))
    act = keys.activation_key(code, keys.aoi_code((k % 20).cast("int")), F.when(k % 3 == 0, "").otherwise("20200101"))
    return c.select(k.alias("id"), label.alias("label"), act.alias("act"), keys.parent_code(act).alias("parent"), keys.code_number(act).alias("number"), keys.safe_word(F.concat(F.lit("-"), F.col("c_mktsegment"), F.lit(" área/1."))).alias("safe"), keys.basename(F.concat_ws("/", act, label)).alias("base"), keys.after_first_slash(F.concat_ws("/", act, label, F.lit("x"))).alias("tail"))


def ascii_names(spark, d):
    x = T.events(spark, d).select("folder_name", keys.task_name(F.concat(F.lit("Évora Río "), "continent", F.lit("/"), "folder_name")).alias("task"))
    return x


def toggles(spark, d):
    r = Registry({"Soil": False}, {"Precipitation": 15})
    return r.frame(spark).select("key", "bands", "n_days")


def _dated(spark, d):
    """Events of several years around the first one that counts, some without a date, with boxes around the points."""
    k = F.col("pid")
    day = F.when(k % 7 == 0, "NODATE").otherwise(F.concat((2014 + k % 8).cast("string"), F.lit("0615")))
    return T.points(spark, d).select("pid", F.concat(F.lit("EMSR"), (k + 600).cast("string"), F.lit("_AOI01_"), day).alias("folder_name"), F.col("x").alias("minx"), F.col("y").alias("miny"), (F.col("x") + 0.5).alias("maxx"), (F.col("y") + 0.25).alias("maxy"))


def scope(spark, d):
    x = _dated(spark, d)
    return x.groupBy(A.route(F.col("folder_name")).alias("source"), A.in_scope(F.col("folder_name")).alias("in_scope")).agg(F.count("*").alias("n"))


def route_products(spark, d):
    x = _dated(spark, d).select(keys.parent_code(F.col("folder_name")).alias("code"))
    return A.routed(x, "code", x.withColumn("via", F.lit("api")), x.withColumn("via", F.lit("html")))


def requests(spark, d):
    x = _dated(spark, d)
    st = x.select("folder_name", F.explode(F.array(F.lit("S1"), F.lit("Soil"), F.lit("Precipitation"))).alias("key"), "pid")
    st = st.select("folder_name", "key", F.when((F.col("pid") % 5 == 0) & (F.col("key") == "S1"), "yes").when((F.col("pid") % 11 == 0) & (F.col("key") == "Soil"), "NA").otherwise("no").alias("state"))
    out = A.requests(x, Registry().frame(spark), st)
    return out.select("folder_name", "key", "file", F.round("pixel", 8).alias("pixel"), *(F.round(c, 4).alias(c) for c in ("minx", "maxy")), "task")


def kinds(spark, d):
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    kind = A.event_kind(F.when(k % 3 == 0, "Flood"), F.when(k % 2 == 0, "").otherwise("Storm"), F.lit("Other"))
    return o.select(k.alias("id"), kind.alias("kind"), A.joined_sensors(_sensor(k), F.when(k % 2 == 0, "").otherwise(_sensor(k, 3))).alias("sensors"))


_DATED = f"""{T.PTS}, dt AS (SELECT pid, x, y, 'EMSR' || CAST(pid + 600 AS VARCHAR) || '_AOI01_' || CASE WHEN pid % 7 = 0 THEN 'NODATE' ELSE CAST(2014 + pid % 8 AS VARCHAR) || '0615' END AS folder_name, pid % 7 = 0 OR 2014 + pid % 8 >= 2017 AS ok FROM pts)"""
_REG = """rg(key, stem, pixel, days, pad) AS (VALUES ('S1', 'S1_VV_VH', 0.0001, 0, 0), ('S2_indices', 'S2_NDVI_NDBI', 0.0001, 0, 0), ('MERIT', 'MERIT_Hydro', 90 / 111000.0::DOUBLE, 0, 0), ('Soil', 'Soil', 250 / 111000.0::DOUBLE, 0, 0), ('ESA_PW', 'ESA_PW', 0.0001, 0, 0), ('Precipitation', 'Precipitation', 0.1, 30, 0.6), ('SoilMoisture', 'SoilMoisture', 0.09516, 30, 0.6)), rd AS (SELECT key, stem, CAST(pixel AS DOUBLE) AS p, days, CAST(pad AS DOUBLE) AS pad FROM rg)"""
_STEM = "CASE key " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.RENAMED.items()) + " END"
_LAYERS = "ly(ord, key, core) AS (VALUES " + ", ".join(f"({k}, '{x}', {{core}})" for k, x in enumerate(T.KEYS)) + ")"
_ALL = _LAYERS.format(core="true")
_SOME = "ly(ord, key, core) AS (VALUES " + ", ".join(f"({k}, '{x}', {str(x != 'Precipitation').lower()})" for k, x in enumerate(T.KEYS)) + ")"
_MISS = """ms AS (SELECT ev.folder_name, count(*) FILTER (ls.key IS NULL) AS n_missing, coalesce(string_agg(ly.key, ',' ORDER BY ly.ord) FILTER (ls.key IS NULL), '') AS missing_layers,
  coalesce(string_agg(ly.key, ',' ORDER BY ly.ord) FILTER (ls.key IS NULL AND ly.core), '') AS core_missing
  FROM ev CROSS JOIN ly LEFT JOIN ls ON ls.folder_name = ev.folder_name AND ls.key = ly.key GROUP BY 1)"""
_LIST = f"concat_ws(', ', {T.S0}, CASE WHEN o_orderkey % 3 = 0 THEN {T.S3} END, CASE WHEN o_orderkey % 5 = 0 THEN 'Unknown-9' END)"
_RES = f"least({_METRES.format(x=T.S0)}, CASE WHEN o_orderkey % 3 = 0 THEN {_METRES.format(x=T.S3)} ELSE 1e9 END)"

QUERIES = {
    "catalog_left_lookup": (left_lookup, f"""WITH {T.EV}, dm AS (SELECT 'EVT' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS folder_name, max_by({T.S0}, o_orderkey) AS sensor FROM orders GROUP BY 1)
 SELECT ev.folder_name, continent, sensor FROM ev LEFT JOIN dm USING (folder_name)"""),
    "catalog_new_events": (new_events, f"WITH {T.EV} SELECT folder_name, basin_id, continent FROM ev WHERE id % 2 = 0 AND id % 3 <> 0"),
    "catalog_merge": (merge, f"WITH {T.EV} SELECT folder_name, basin_id, CASE WHEN id % 3 = 0 THEN 'train' END AS split, CASE WHEN id % 3 <> 0 THEN continent END AS continent FROM ev WHERE id % 3 = 0 OR id % 2 = 0"),
    "missing_layers": (missing, f"WITH {T.EV}, {T.LS}, {_ALL}, {_MISS} SELECT * FROM ms"),
    "core_gate": (gate, f"WITH {T.EV}, {T.LS}, {_SOME}, {_MISS} SELECT folder_name FROM ms WHERE core_missing = ''"),
    "status_upsert": (upsert, f"WITH {_LOG} SELECT * FROM cur"),
    "status_last_wins": (last_row, f'WITH {_LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY folder_name ORDER BY seq DESC) AS k FROM lg) SELECT folder_name, seq, "S1", "MERIT" FROM r WHERE k = 1'),
    "status_na_gate": (na_gate, f"""WITH {_LOG} SELECT folder_name FROM cur WHERE coalesce("S1", '') <> 'NA' AND coalesce("MERIT", '') <> 'NA' AND (coalesce("S1", 'no') = 'no' OR coalesce("MERIT", 'no') = 'no')"""),
    "status_refresh": (refresh, f"""WITH {_LOG}, {T.EV}, {T.LS}, f AS (SELECT folder_name, length > 0 AND bands = 2 AS ok FROM ls WHERE key = 'S1')
 SELECT folder_name, CASE WHEN "MERIT" = 'NA' THEN 'NA' WHEN coalesce(ok, false) THEN 'yes' ELSE 'no' END AS status FROM cur LEFT JOIN f USING (folder_name)"""),
    "patch_index": (dense, f"WITH {T.EV}, {T.PT} SELECT o_custkey, o_orderkey, patch_number, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS idx FROM pt WHERE flood_pixels % 3 <> 0"),
    "sensor_resolution": (resolution, f"""WITH x AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE {_LIST} END AS sensors, CASE WHEN o_orderkey % 11 <> 0 THEN CAST({_RES} AS DOUBLE) END AS metres FROM orders)
 SELECT *, CASE WHEN metres IS NULL THEN 'unknown' WHEN metres < 3 THEN 'very-high' WHEN metres < 10 THEN 'high' ELSE 'medium' END AS cls FROM x"""),
    "climate_class": (climate, """WITH x AS (SELECT o_orderkey AS id, CAST(o_orderkey % 33 - 1 AS INTEGER) AS v FROM orders), y AS (SELECT *, CASE WHEN v <= 0 OR v > 30 THEN NULL WHEN v <= 3 THEN 'A' WHEN v <= 7 THEN 'B' WHEN v <= 16 THEN 'C' WHEN v <= 28 THEN 'D' ELSE 'E' END AS letter FROM x)
 SELECT *, CASE letter WHEN 'A' THEN 'A Tropical' WHEN 'B' THEN 'B Arid' WHEN 'C' THEN 'C Temperate' WHEN 'D' THEN 'D Cold' WHEN 'E' THEN 'E Polar' END AS label FROM y"""),
    "continent_rules": (continents, f"""WITH {T.PTS}, x AS (SELECT *, list_extract(['Asia', 'Australia/Oceania', 'Europe', 'Antarctica'], CAST(pid % 4 + 1 AS BIGINT)) AS n FROM pts)
 SELECT pid, CASE WHEN n = 'Asia' AND y < -1 AND x >= 120 THEN 'Australia/Oceania' WHEN n = 'Asia' AND x <= 30 AND y >= 40 THEN 'Europe' ELSE n END AS label FROM x"""),
    "basin_l5": (basins, "SELECT o_orderkey AS id, substr(CAST(o_orderkey * 7919 + 230000000 AS VARCHAR), 1, 5) AS l5 FROM orders"),
    "event_size_bins": (size_bins, f"WITH {T.EV} SELECT CASE WHEN aoi_area_km2 < 100 THEN 'small<100' WHEN aoi_area_km2 < 1000 THEN 'med100-1k' ELSE 'large>1k' END AS bin, count(*) AS n FROM ev GROUP BY 1"),
    "raster_validity": (validity, f"WITH {T.EV}, {T.LS} SELECT key, count(*) FILTER (length > 0 AND bands = 2) AS valid, count(*) AS files FROM ls GROUP BY 1"),
    "tile_validity": (broken, f"WITH {T.EV}, {T.LS}, x AS (SELECT folder_name, key, bool_or(length = 0) AS broken, count(*) AS tiles FROM ls GROUP BY 1, 2) SELECT key, count(*) AS layers, CAST(sum(tiles) AS BIGINT) AS tiles FROM x WHERE broken GROUP BY 1"),
    "listing_diff": (difference, f"WITH {T.EV}, {T.LS} SELECT folder_name, 'drive/' || {_STEM} || '-0000000000-0000000256.tif' AS name FROM ls WHERE id % 2 <> 0"),
    "best_file": (best_file, """WITH x AS (SELECT 'EVT' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS folder_name, c_custkey AS id, unnest([0, 1, 2, 3]) AS k FROM customer), y AS (SELECT folder_name, list_extract([0, 2, 9, 1], k + 1) AS rule,
 list_extract(['EMSR_Observed_Event_A', 'crisis_information_poly', 'ObservedEvent_line', 'crisisEventA'], k + 1) || '_' || CAST(id % 4 AS VARCHAR) AS stem FROM x WHERE (id + k) % 3 <> 0)
 SELECT folder_name, first(stem ORDER BY rule, stem) AS stem, min(rule) AS rule FROM y WHERE rule < 9 GROUP BY 1"""),
    "key_functions": (names, """WITH x AS (SELECT c_custkey AS id, c_mktsegment, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 5 > 0 THEN 'DEL_MONIT0' || CAST(c_custkey % 5 AS VARCHAR) ELSE 'DEL_PRODUCT' END AS label,
 'EMSR' || CAST(c_custkey + 100 AS VARCHAR) || '_AOI' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') || '_' || CASE WHEN c_custkey % 3 = 0 THEN 'NODATE' ELSE '20200101' END AS act FROM customer)
 SELECT id, label, act, 'EMSR' || CAST(id + 100 AS VARCHAR) AS parent, CAST(id + 100 AS INTEGER) AS number, c_mktsegment || '_área_1' AS safe, label AS base, label || '/x' AS tail FROM x"""),
    "task_name": (ascii_names, f"WITH {T.EV} SELECT folder_name, substr('Evora_Rio_' || replace(continent, ' ', '_') || '_' || folder_name, 1, 70) AS task FROM ev"),
    "scope_and_source": (scope, f"WITH {_DATED} SELECT CASE WHEN pid + 600 >= 656 THEN 'api' ELSE 'html' END AS source, ok AS in_scope, count(*) AS n FROM dt GROUP BY 1, 2"),
    "source_routing": (route_products, f"WITH {_DATED} SELECT 'EMSR' || CAST(pid + 600 AS VARCHAR) AS code, CASE WHEN pid + 600 >= 656 THEN 'api' ELSE 'html' END AS via FROM dt"),
    "request_plan": (requests, f"""WITH {_DATED}, {_REG} SELECT folder_name, key, CASE WHEN days > 0 AND pid % 7 <> 0 THEN stem || '_' || CAST(2014 + pid % 8 AS VARCHAR) || '0516_' || CAST(2014 + pid % 8 AS VARCHAR) || '0614' ELSE stem END AS file, round(p, 8) AS pixel,
 round(floor(CASE WHEN pad > 0 THEN greatest(x - pad, -180) ELSE x END / p) * p, 4) AS minx, round(ceil(CASE WHEN pad > 0 THEN least(y + 0.25::DOUBLE + pad, 90) ELSE y + 0.25::DOUBLE END / p) * p, 4) AS maxy, folder_name || '_' || key AS task
 FROM dt CROSS JOIN rd WHERE ok AND pid % 11 <> 0 AND NOT (key = 'S1' AND pid % 5 = 0)"""),
    "event_kind": (kinds, f"SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'Flood' WHEN o_orderkey % 2 <> 0 THEN 'Storm' ELSE 'Other' END AS kind, {T.S0} || CASE WHEN o_orderkey % 2 <> 0 THEN ', ' || {T.S3} ELSE '' END AS sensors FROM orders"),
    "registry_toggles": (toggles, "SELECT * FROM (VALUES ('S1', 2, 0), ('S2_indices', 2, 0), ('MERIT', 4, 0), ('ESA_PW', 1, 0), ('Precipitation', 15, 15), ('SoilMoisture', 30, 30)) AS t(key, bands, n_days)"),
}
