"""Files, tables, registry and streams."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import geo
from rasterloom.operators import acquire as A
from rasterloom.operators import listing as L
from rasterloom.operators import tables as B
from rasterloom.registry import CORE, Layer, Registry
from rasterloom.session import ship_package
from rasterloom.sources import documents as D
from rasterloom.sources import files as S
from rasterloom.sources import tables as T
from rasterloom.streaming import state


def test_rasters_round_trip(spark, tmp_path):
    ship_package(spark)
    S.register(spark)
    a = np.arange(2 * 5 * 4, dtype=np.float32).reshape(2, 5, 4)
    S.write_tiff(str(tmp_path / "ev1" / "x.tif"), a, 10.0, 50.0, 0.5, 0.25, 9999.0)
    S.write_tiff(str(tmp_path / "ev2" / "m.tif"), (a[:1] > 7).astype(np.uint8), 0.0, 1.0, 1.0, 1.0, None)
    (tmp_path / "ev2" / "bad.tif").write_bytes(b"no raster")
    got = spark.read.format("raster").load(str(tmp_path)).orderBy("event", "path", "band").collect()
    one = [r for r in got if r.event == "ev1"]
    assert [np.array(r.data, np.float32).reshape(5, 4).tolist() for r in one] == a.tolist()
    assert (one[0].minx, one[0].maxy, one[0].res_x, one[0].res_y, one[0].nodata, one[0].w, one[0].h) == (10.0, 50.0, 0.5, 0.25, 9999.0, 4, 5)
    assert [r.bands for r in got if r.path.endswith("bad.tif")] == [0]
    meta = spark.read.format("raster").option("metadata", "true").load(str(tmp_path)).collect()
    assert len(meta) == 3 and all(r.data is None for r in meta)
    row = [("p0", 2, 5, 4, 10.0, 50.0, 0.5, 0.25, 9999.0, False, [float(x) for x in a.ravel()])]
    df = spark.createDataFrame(row, "name string, bands int, h int, w int, minx double, maxy double, res_x double, res_y double, nodata double, mask boolean, data array<double>")
    df.write.format("raster").mode("append").save(str(tmp_path / "out"))
    back = spark.read.format("raster").load(str(tmp_path / "out")).orderBy("band").collect()
    assert [r.data for r in back] == [[float(x) for x in b.ravel()] for b in a]


def shape(path, polygons):
    body = b""
    for k, rings in enumerate(polygons):
        pts = [p for r in rings for p in r]
        starts = np.cumsum([0, *(len(r) for r in rings[:-1])])
        rec = struct.pack("<I4d2I", 5, 0, 0, 1, 1, len(rings), len(pts)) + struct.pack(f"<{len(starts)}I", *starts) + b"".join(struct.pack("<2d", *p) for p in pts)
        body += struct.pack(">2I", k + 1, len(rec) // 2) + rec
    path.write_bytes(struct.pack(">7I", 9994, 0, 0, 0, 0, 0, 50 + len(body) // 2) + struct.pack("<2I", 1000, 5) + b"\0" * 64 + body)


def test_polygons_are_read(spark, tmp_path):
    S.register(spark)
    rings = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0)]], [[(9.0, 9.0), (10.0, 9.0), (9.0, 10.0)]]]
    shape(tmp_path / "p.shp", rings)
    names, values = [b"PFAF_ID", b"NAME"], [("123456789012", "ab"), ("7", "cd")]
    fields = b"".join(n.ljust(11, b"\0") + (b"N" if k == 0 else b"C") + b"\0" * 4 + bytes([12 if k == 0 else 5]) + b"\0" * 15 for k, n in enumerate(names))
    rows = b"".join(b" " + a.rjust(12).encode() + b.ljust(5).encode() for a, b in values)
    (tmp_path / "p.dbf").write_bytes(b"\x03\x18\x01\x01" + struct.pack("<IHH", 2, 32 + len(fields) + 1, 18) + b"\0" * 20 + fields + b"\r" + rows)
    got = spark.read.format("polygons").option("id", "PFAF_ID").load(str(tmp_path / "p.shp")).orderBy("poly_id").collect()
    assert [r.poly_id for r in got] == [7, 123456789012]
    assert [[tuple(p) for p in ring] for ring in got[1].rings] == rings[0]
    l5 = spark.read.format("polygons").option("id", "PFAF_ID").load(str(tmp_path / "p.shp")).select(geo.basin_l5(F.col("poly_id"))).collect()
    assert sorted(r[0] for r in l5) == ["12345", "7"]


def test_pages_follow_their_links(spark, tmp_path):
    S.register(spark)
    for k, after in ((0, "page_1.json"), (1, "page_2.json"), (2, "page_0.json")):
        (tmp_path / f"page_{k}.json").write_text(json.dumps({"next": after, "results": [{"code": f"EMSR{k}", "name": "n", "activationTime": "2020-05-01T00:00:00", "category": {"name": "Flood"}, "countries": [], "n_products": 1}]}))
    pages = spark.read.format("json_pages").load(str(tmp_path))
    assert pages.count() == 3
    assert sorted(r.code for r in D.activations(pages, "2020-01-01", "2020-12-31").collect()) == ["EMSR0", "EMSR1", "EMSR2"]


def test_listing_and_names(spark, tmp_path):
    for n, size in (("S1-0000000000-0000000000.tif", 3), ("Precipitation_20200101_20200130.tif", 0), ("other.tif", 1)):
        (tmp_path / "f").mkdir(exist_ok=True)
        (tmp_path / "f" / n).write_bytes(b"x" * size)
    got = {r.name: r for r in S.listing(spark, str(tmp_path)).withColumn("key", L.layer_of(F.col("name"))).collect()}
    assert {n: (r.key, r.length, r.folder_name) for n, r in got.items()} == {"S1-0000000000-0000000000.tif": ("S1", 3, "f"), "Precipitation_20200101_20200130.tif": ("Precipitation", 0, "f"), "other.tif": (None, 1, "f")}


def test_best_files(spark):
    rows = [("a", "x/RTP/z.pdf"), ("a", "x/DELINEATION/a.pdf"), ("b", "x/DEL1.pdf"), ("b", "x/a.pdf"), ("c", "x/a.PDF"), ("d", "x/a.txt")]
    got = {r.k: (r.path, r.rule) for r in L.find_map(spark.createDataFrame(rows, "k string, path string"), ["k"]).collect()}
    assert got == {"a": ("x/RTP/z.pdf", 0), "b": ("x/DEL1.pdf", 1), "c": ("x/a.PDF", 2)}
    stems = [("a", "EMSR1_areaOfInterestA"), ("a", "EMSR1_area_of_interest_line"), ("b", "EMSR1_AOI1_DTL2"), ("c", "nothing")]
    got = {r.k: r.stem for r in L.find_area(spark.createDataFrame(stems, "k string, stem string"), ["k"]).collect()}
    assert got == {"a": "EMSR1_areaOfInterestA", "b": "EMSR1_AOI1_DTL2"}


def test_tables_round_trip_blanks(spark, tmp_path):
    df = spark.createDataFrame([("f1", "NA", ""), ("f2", "yes", None)], "folder_name string, S1 string, note string")
    T.write(df, str(tmp_path / "t"), ["folder_name", "S1", "note", "extra"])
    back = T.read(spark, str(tmp_path / "t"), T.strings(["folder_name", "S1", "note", "extra"])).orderBy("folder_name").collect()
    assert [(r.S1, r.note or "", r.extra or "") for r in back] == [("NA", "", ""), ("yes", "", "")]
    assert T.filled(df, T.SCHEMAS["missing_layers"]).columns == T.SCHEMAS["missing_layers"]


def test_upserts_are_idempotent(spark):
    log = spark.createDataFrame([("a", 1, "no", None), ("a", 2, None, "yes"), ("a", 3, "yes", None), ("b", 1, "NA", None)], "k string, seq int, s1 string, s2 string")
    now = B.upserted(log, ["k"], "seq")
    assert {r.k: (r.s1, r.s2, r.seq) for r in now.collect()} == {"a": ("yes", "yes", 3), "b": ("NA", None, 1)}
    assert sorted(map(tuple, B.upserted(now, ["k"], "seq").collect())) == sorted(map(tuple, now.collect()))
    assert {tuple(r) for r in B.last_wins(log, ["k"], "seq").collect()} == {("a", 3, "yes", None), ("b", 1, "NA", None)}


def test_merge_keeps_settled_rows(spark):
    old = spark.createDataFrame([("a", "x", "train")], "k string, v string, split string")
    new = spark.createDataFrame([("a", "y", 1), ("b", "z", 2)], "k string, v string, more int")
    once = B.merged(old, new, ["k"])
    assert {tuple(r) for r in once.collect()} == {("a", "x", "train", None), ("b", "z", None, 2)}
    assert {tuple(r) for r in B.merged(once, new, ["k"]).collect()} == {tuple(r) for r in once.collect()}


def test_dense_index(spark):
    rows = [(k * 37 % 1000, k) for k in range(1000)]
    got = B.dense_index(spark.createDataFrame(rows, "a int, b int"), ["a"], "n").collect()
    assert all(r.n == r.a for r in got) and len(got) == 1000


def test_append_once_and_regions(spark, tmp_path):
    store = str(tmp_path / "store")
    a = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "k string, v int")
    assert A.append_once(a, store, ["k"]) == 2 and A.append_once(a, store, ["k"]) == 0
    assert A.append_once(spark.createDataFrame([("c", 3)], "k string, v int"), store, ["k"]) == 1
    assert spark.read.parquet(store).count() == 3
    both = A.regions([a, spark.createDataFrame([("z", "w")], "k string, other string")])
    assert both.columns == ["k", "v", "other"] and both.count() == 4


def test_registry(spark):
    r = Registry({"Soil": False}, {"Precipitation": 5})
    made = r.register(Layer("Custom", "Custom", "temporal", 1, 500.0, 3, builder="mine"))
    assert not made.core

    @r.builder("mine")
    def mine(spark, days):
        return spark.range(days)

    assert r.build("Custom", spark).count() == 3 and r.by_key("Precipitation").band_count == 5 and r.by_key("none") is None
    assert [x.key for x in r.enabled()] == [x.key for x in CORE if x.key != "Soil"] + ["Custom"]
    with pytest.raises(ValueError):
        r.register(Layer("S1", "x", "static", 1, 1.0))
    with pytest.raises(LookupError):
        r.build("Soil", spark)
    assert r.frame(spark).where("core").count() == 6


def test_status_stream(spark, tmp_path):
    src, log, mark = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "mark")
    schema = "k string, seq int, s1 string"
    for part in ([("a", 1, "no")], [("a", 2, "yes"), ("b", 3, None)]):
        spark.createDataFrame(part, schema).write.mode("append").json(src)
        state.follow_status(spark.readStream.schema(schema).json(src), ["k"], "seq", log, mark).awaitTermination()
    assert {tuple(r) for r in state.current_status(spark, log, ["k"], "seq").collect()} == {("a", "yes", 2), ("b", None, 3)}


def test_daily_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "2020-01-01 01:00:00", 2.0), (1, "2020-01-01 05:00:00", 4.0), (1, "2020-01-09 00:00:00", 1.0)], "pixel long, t string, value double").select("pixel", F.to_timestamp("t").alias("ts"), "value").write.parquet(src)
    q = state.daily_sums(spark.readStream.schema("pixel long, ts timestamp, value double").parquet(src)).writeStream.format("memory").queryName("days").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.pixel, str(r.day), r.total) for r in spark.table("days").collect()] == [(1, "2020-01-01", 3.0)]


def test_products_and_headings(spark):
    body = {"results": [{"aois": [{"number": 3, "name": "Vila Río/1", "products": [{"type": "DEL", "monitoring": True, "monitoringNumber": 2, "downloadPath": "u", "version": {"deliveryTime": "2020-05-06T01:02:03Z"}}, {"type": "REF", "monitoring": False, "monitoringNumber": 0, "downloadPath": "", "version": {"deliveryTime": "bad"}}, {"type": "GRA", "monitoring": True, "monitoringNumber": 0, "downloadPath": "v", "version": {"deliveryTime": "bad"}}]}]}]}
    df = spark.createDataFrame([("EMSR1", json.dumps(body)), ("EMSR2", "{}")], "code string, body string")
    got = sorted(tuple(r) for r in D.products(df).collect())
    assert got == [("EMSR1", "AOI03", "Vila_Río_1", "DEL_MONIT02", "u", "20200506"), ("EMSR1", "AOI03", "Vila_Río_1", "GRA_PRODUCT", "v", None)]
    rows = spark.createDataFrame([("p", 0, None), ("p", 1, "A"), ("p", 2, None), ("p", 3, "B"), ("p", 4, None)], "page string, pos int, h string")
    assert [r.heading for r in D.carried(rows, "page", "pos", F.col("h")).orderBy("pos").collect()] == [None, "A", "A", "B", "B"]
    blocks = spark.createDataFrame([(["a\nb", " ", "c "],)], "b array<string>")
    assert blocks.select(D.map_text(F.col("b"))).first()[0] == "a b | c"
