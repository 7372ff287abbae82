"""Queries about components, strata, assignment, leakage and balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.operators import split as S
from rasterloom.plans import standins as T

_ATTR = f"""{T.EV}, {T.PT},
n1 AS (SELECT folder_name, min(patch_index) AS first_pos, count(*) AS n, any_value(basin_id) AS basin_id, any_value(continent) AS cont FROM pt GROUP BY 1),
rk AS (SELECT folder_name, resolution_class, row_number() OVER (PARTITION BY folder_name ORDER BY count(*) DESC, resolution_class) AS r FROM pt GROUP BY 1, 2),
evn AS (SELECT n1.*, rk.resolution_class AS res, CASE WHEN aoi_area_km2 < 100 THEN 'small<100' WHEN aoi_area_km2 < 1000 THEN 'med100-1k' ELSE 'large>1k' END AS size
  FROM n1 JOIN rk ON rk.folder_name = n1.folder_name AND r = 1 JOIN ev ON ev.folder_name = n1.folder_name),
codes AS (SELECT first_pos, unnest(string_split(basin_id, '-')) AS code FROM evn),
links AS (SELECT DISTINCT a.first_pos AS p, b.first_pos AS q FROM codes a JOIN codes b USING (code)),
reach(p, q) AS (SELECT first_pos, first_pos FROM evn UNION SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p),
comp AS (SELECT p AS first_pos, min(q) AS component FROM reach GROUP BY 1),
long AS (SELECT component, first_pos, n, unnest(['cont', 'res', 'size']) AS kind, unnest([cont, res, size]) AS value FROM evn JOIN comp USING (first_pos)),
st AS (SELECT component, kind, value, CAST(sum(n) AS BIGINT) AS n, min(first_pos) AS pos FROM long GROUP BY 1, 2, 3)"""
_WITH = "WITH RECURSIVE " + _ATTR


def _attributes(spark, d):
    return S.event_attributes(T.patches(spark, d), T.events(spark, d))


def components(spark, d):
    return S.components(_attributes(spark, d))


def strata(spark, d):
    a = _attributes(spark, d)
    return S.strata(a, S.components(a))


def _table(spark, d):
    return S.component_table(strata(spark, d))


def oversized(spark, d):
    return S.oversized(_table(spark, d))


def dominant(spark, d):
    return _table(spark, d).select("component", "cont", "n")


def assignment(spark, d):
    return S.assign(T.patches(spark, d), T.events(spark, d))


def assignment_shares(spark, d):
    p = T.patches(spark, d)
    return S.shares(S.gate(S.with_split(p, S.assign(p, T.events(spark, d)))))


def attributes(spark, d):
    return _attributes(spark, d).select("folder_name", "first_pos", "n", "cont", "res", "size", F.array_join("codes", "-").alias("codes"))


def leakage(spark, d):
    return S.leakage(T.split_patches(spark, d))


def shares(spark, d):
    return S.shares(T.split_patches(spark, d))


def crosstab(spark, d):
    return S.crosstab(T.split_patches(spark, d), "continent")


def with_split(spark, d):
    """New labels for some events, earlier ones for the rest."""
    p = T.split_patches(spark, d)
    new = p.where("o_custkey % 3 = 0").select("folder_name").distinct().withColumn("split", F.lit("new"))
    return S.with_split(p, new).groupBy("split").agg(F.count("*").alias("n"))


_SP = f"sp AS (SELECT pt.*, {T.SPLIT_SQL} AS split FROM pt)"
_PCT = ", ".join(f"round(count(*) FILTER (split = '{s}') * 100.0 / count(*), 2) AS {s}" for s in S.SPLITS)

QUERIES = {
    "split_attributes": (attributes, f"WITH RECURSIVE {_ATTR} SELECT folder_name, first_pos, n, cont, res, size, array_to_string(list_sort(list_distinct(string_split(basin_id, '-'))), '-') AS codes FROM evn"),
    "split_components": (components, _WITH + " SELECT folder_name, component FROM evn JOIN comp USING (first_pos)"),
    "split_strata": (strata, _WITH + " SELECT * FROM st"),
    "split_dominant": (dominant, _WITH + " SELECT component, first(value ORDER BY n DESC, pos) AS cont, CAST(sum(n) AS BIGINT) AS n FROM st WHERE kind = 'cont' GROUP BY 1"),
    "split_oversized": (oversized, _WITH + ", ct AS (SELECT component, first(value ORDER BY n DESC, pos) AS cont, sum(n) AS n FROM st WHERE kind = 'cont' GROUP BY 1), tt AS (SELECT *, sum(n) OVER (PARTITION BY cont) AS total FROM ct) SELECT component, 'train' AS split FROM tt WHERE n > 0.15::DOUBLE * total"),
    "split_assignment": (assignment, None),
    "split_assignment_shares": (assignment_shares, None),
    "split_leakage": (leakage, f"""WITH {T.EV}, {T.PT}, {_SP}, b AS (SELECT unnest(string_split(basin_id, '-')) AS id, split FROM sp),
 k AS (SELECT 'basin' AS unit, count(DISTINCT split) AS k FROM b GROUP BY id UNION ALL SELECT 'event', count(DISTINCT split) FROM sp GROUP BY folder_name)
 SELECT unit, count(*) AS units, count(*) FILTER (k > 1) AS leaking FROM k GROUP BY 1"""),
    "split_shares": (shares, f"WITH {T.EV}, {T.PT}, {_SP} SELECT split, count(*) AS patches, count(DISTINCT folder_name) AS events, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS share FROM sp GROUP BY 1"),
    "split_crosstab": (crosstab, f"WITH {T.EV}, {T.PT}, {_SP} SELECT continent AS category, {_PCT}, count(*) AS patches FROM sp GROUP BY 1"),
    "split_relabel": (with_split, f"WITH {T.EV}, {T.PT}, {_SP} SELECT CASE WHEN o_custkey % 3 = 0 THEN 'new' ELSE split END AS split, count(*) AS n FROM sp GROUP BY 1"),
}
