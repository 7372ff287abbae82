"""Map texts: dates and sensors, including odd spellings."""

import pytest
from pyspark.sql import functions as F

from rasterloom.functions import dates, keys, sensors


def ask(spark, texts, *columns):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", *columns).collect()
    return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in sorted(rows, key=lambda r: r.k)]


def test_days(spark):
    cases = {
        "Situation as of 31/08/2012": "20120831",
        "situation au 1.2.2013 x": "20130201",
        "Situazione al 05/13/2014": "20140513",
        "Stand vom 3/4/2015": "20150403",
        "Flood – 9/9/2016": "20160909",
        "as of 31082012 but 02/03/2017": "20170302",
        "Situation as of 99/99/2012, Stand vom 01.02.2018": "20180201",
        "nothing 40/40/2020 then 7.8.2020": "20200807",
        "no day": None,
        "29/02/2019": None,
    }
    assert ask(spark, list(cases), dates.map_day(F.col("t"))) == list(cases.values())


def test_names(spark):
    cases = {
        "Post-event image: R ADAR S AT 2 Data and products © MDA": "RADARSAT-2",
        "RADARSAT Constellation Mission": "RADARSAT Constellation",
        "Sentinal-1B (2020)": "Sentinel-1B",
        "Sentinel-1A/B": "Sentinel-1A/B",
        "Sentinel-2 2021": "Sentinel-2",
        "plèiades 1A": "Pléiades-1A",
        "SPOT 6/7 © Airbus": "SPOT-6/7",
        "WorlView 3": "WorldView-3",
        "CSG1": "COSMO-SkyMed SG",
        "COSMO-SkyMed © ASI": "COSMO-SkyMed",
        "IE03": "ICEYE",
        "GeoEye": "GeoEye-1",
        ": Landsat-9, provided under licence": "Landsat-9",
        "Some new": "Some new",
        "Data of a place and more": "Data of a place and more",
        "Image of a place and more": "ESRI World Imagery",
        "x": "",
        "": "",
    }
    assert ask(spark, list(cases), sensors.sensor_name(F.col("t"))) == list(cases.values())


def test_entries(spark):
    text = "Sentinel-2A (2022) (a cquired on 03/04/2022, GSD 10 m, approx. 12,5 % cloud"
    (e,) = ask(spark, [text], sensors.image_entry(F.col("t")))
    assert tuple(e) == ("Sentinel-2A", "20220403", "10", "12.5")


def test_sources_of_three_eras(spark):
    new = "x | Data sources: Pre-event image: Sentinel-2A © ESA (acquired on 1/2/2020). Post-event image: RADARSAT 2 © MacDonald, Dettwiler and Associates (acquired on 3/2/2020, resolution 3 m) and Sentinel-1 (acquired on 4/2/2020) Base vector layers"
    middle = "Pre-even t im a ge: SPOT 6 (acquired on 5/6/2015) Post-even t im age: PAZ satellite image (a cquired on 7/6/2015) | Data sources none Base vector"
    old = "Flooded areas were derived from COSMO-SkyMed images (31/08/2012), 3 m resolution. The background is RapidEye (01/07/2011)."
    none = "no sensors at all"
    got = ask(spark, [new, middle, old, none], sensors.sources(F.col("t")))
    assert (got[0].pre_sensor, got[0].pre_day, got[0].post_sensor, got[0].post_gsd_m, got[0].post_sensor2, got[0].post_day2) == ("Sentinel-2A", "20200201", "RADARSAT-2", "3", "Sentinel-1", "20200204")
    assert (got[1].pre_sensor, got[1].post_sensor, got[1].post_day) == ("SPOT-6", "PAZ", "20150607")
    assert (got[2].post_sensor, got[2].post_day, got[2].post_gsd_m, got[2].pre_sensor, got[2].pre_day) == ("COSMO-SkyMed", "20120831", "3", "RapidEye", "20110701")
    assert (got[3].pre_sensor, got[3].post_sensor) == ("", "")


def test_finest_pixel(spark):
    got = ask(spark, ["RADARSAT-2, Sentinel-1A", "Pléiades Neo;SPOT", "WorldView", "", None], sensors.finest(F.col("t")))
    assert got == [4.0, 0.3, None, None, None]


@pytest.mark.parametrize(("raw", "want"), [("Évora Río/1", "Évora_Río_1"), ("-a b-", "a_b"), ("__", "")])
def test_safe_words(spark, raw, want):
    assert ask(spark, [raw], keys.safe_word(F.col("t"))) == [want]


def test_task_names(spark):
    assert ask(spark, ["Évora Río;(1)", None], keys.task_name(F.col("t"))) == ["Evora_Rio;_1_", None]


def test_urls_and_files(spark):
    assert ask(spark, ["https://x/a/b.pdf?q=1"], keys.file_of_url(F.col("t"))) == ["b.pdf"]
    assert ask(spark, ["/a", "http://y/b", "c"], keys.absolute_url(F.col("t"), F.lit("https://x"))) == ["https://x/a", "http://y/b", "https://x/c"]
    got = ask(spark, ["EMSR12_AOI01_DEL_PRODUCT_r1_x.pdf", "other"], keys.product_file(F.col("t")))
    assert (tuple(got[0]), got[1]) == (("EMSR12", "AOI01", "DEL_PRODUCT"), None)


def test_other_years(spark):
    rows = spark.sql("SELECT * FROM VALUES (date'2020-02-29'), (date'2025-03-01'), (date'2023-05-06') AS t(d)")
    got = [tuple(r) for r in rows.select(F.date_format(dates.same_day(F.col("d"), dates.fallback_year(F.col("d"))), "yyyyMMdd")).collect()]
    assert got == [(None,), ("20240301",), ("20240506",)]
