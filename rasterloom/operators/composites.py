"""Composites and daily series over long tables of pixel observations.

An observation is ``(pixel, ts, value columns, ...)``. All windows of a composite are
computed in one aggregation instead of one remote round trip each; which window counts
is decided afterwards by coverage.

``event`` is the day of the one event that all rows belong to, or a table
``(event, day)`` of many: then observations and pixels have a column ``event`` too, all
events are computed in one plan, and the result has that column first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.config import DEFAULTS
from rasterloom.functions.dates import fallback_year, same_day


def normalised_difference(a: Column, b: Column) -> Column:
    return (a - b) / F.nullif(a + b, F.lit(0.0))


def gap_filled(first: Column, *more: Column) -> Column:
    return F.coalesce(first, *more)


def coverage(valid: Column, area: Column) -> Column:
    """Percent of the area that is valid, as an aggregate."""
    return F.lit(100.0) * F.sum(F.when(valid, area).otherwise(0.0)) / F.sum(area)


def _keyed(obs: DataFrame, event: Column | DataFrame) -> tuple[DataFrame, Column, list[str]]:
    """Observations with their event's day, the day, and the columns that tell events apart."""
    if isinstance(event, Column):
        return obs, event, []
    return obs.join(event.select("event", F.col("day").alias("__day")), "event"), F.col("__day"), ["event"]


def staged(obs: DataFrame, pixels: DataFrame, stages: list[Column], values: list[str], least: float, labels: list, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Medians for each stage, the first stage with enough coverage, and the gap-filled result.

    ``stages`` are conditions on an observation. A stage is measured on its own medians,
    all bands being there; the result fills gaps from the stages before it, in order. If
    no stage suffices the last one with any observation counts and ``ok`` is false.
    ``pixels(pixel, area)`` is what coverage refers to; pixels without observations stay,
    with nulls. Each combination of ``by`` is decided for itself.
    """
    key = [*by, "pixel"]
    median = [F.median(F.when(s, F.col(v))).alias(f"__{v}_{k}") for k, s in enumerate(stages) for v in values]
    seen = [F.count_if(s).alias(f"__n_{k}") for k, s in enumerate(stages)]
    wide = pixels.join(obs.groupBy(*key).agg(*median, *seen), key, "left")
    whole = lambda k: F.greatest(*(F.col(f"__{v}_{k}").isNull().cast("int") for v in values), F.lit(0)) == 0
    totals = wide.groupBy(*by).agg(*(coverage(whole(k), F.col("area")).alias(f"c{k}") for k in range(len(stages))), *(F.sum(F.coalesce(f"__n_{k}", F.lit(0))).alias(f"n{k}") for k in range(len(stages))))
    used = F.coalesce(*(F.when((F.col(f"n{k}") > 0) & (F.col(f"c{k}") >= least), k) for k in range(len(stages))), F.greatest(*(F.when(F.col(f"n{k}") > 0, k) for k in range(len(stages))), F.lit(0)))
    decided = totals.select(*by, used.alias("__used"), *(f"c{k}" for k in range(len(stages))))
    decided = decided.select(*by, "__used", F.element_at(F.array(*(F.col(f"c{k}") for k in range(len(stages)))), F.col("__used") + 1).alias("coverage"))
    joined = wide.join(decided, by) if by else wide.join(F.broadcast(decided), F.lit(True))
    filled = [F.coalesce(*(F.when(F.lit(k) <= F.col("__used"), F.col(f"__{v}_{k}")) for k in range(len(stages)))).alias(v) for v in values]
    label = F.element_at(F.array(*map(F.lit, labels)), F.col("__used") + 1).alias("stage")
    return joined.select(*key, *filled, label, "coverage", (F.col("coverage") >= least).alias("ok"))


def widening(obs: DataFrame, pixels: DataFrame, event: Column | DataFrame, values: list[str], days: tuple = DEFAULTS.s1_days, least: float = DEFAULTS.s1_coverage) -> DataFrame:
    """Radar composite: windows before the event, the shortest that covers enough."""
    obs, event, by = _keyed(obs, event)
    day = F.to_date("ts")
    rows = obs.where((day < event) & (day >= F.date_sub(event, max(days))))
    return staged(rows, pixels, [day >= F.date_sub(event, d) for d in days], values, least, list(days), by)


def relaxing(obs: DataFrame, pixels: DataFrame, event: Column | DataFrame, values: list[str], clouds: tuple = DEFAULTS.s2_clouds, days: int = DEFAULTS.s2_days, least: float = DEFAULTS.s2_coverage, seasonal: bool = True) -> DataFrame:
    """Optical composite: cloud limits that rise until enough is covered, then the season of another year.

    ``uses_future`` tells where imagery after the event was used. February 29 has no
    season in common years. Without ``seasonal`` the event's own season is the result,
    whatever it covers.
    """

    events = event
    obs, event, by = _keyed(obs, event)
    key = [*by, "pixel"]

    def season(day: Column) -> DataFrame:
        d = F.to_date("ts")
        rows = obs.where((d < day) & (d >= F.date_sub(day, days)))
        return staged(rows, pixels, [F.col("cloud_pct") < c for c in clouds], values, least, list(clouds), by)

    own = season(event)
    if not seasonal:
        return own.withColumn("uses_future", F.lit(False))
    year = fallback_year(event)
    other = season(same_day(event, year))
    both = own.join(other.select(*key, *(F.col(c).alias(f"__{c}") for c in (*values, "coverage", "ok"))), key)
    both = _keyed(both, events)[0]
    fall = ~F.col("ok") & (F.coalesce(F.col("__coverage"), F.lit(0.0)) > 0)
    return both.select(
        *key,
        *(F.when(fall, F.coalesce(v, f"__{v}")).otherwise(F.col(v)).alias(v) for v in values),
        "stage",
        F.when(fall, F.col("__coverage")).otherwise(F.col("coverage")).alias("coverage"),
        F.when(fall, F.col("__ok")).otherwise(F.col("ok")).alias("ok"),
        (fall & (year > F.year(event))).alias("uses_future"),
    )


def radar(acq: DataFrame) -> DataFrame:
    """Acquisitions with both polarisations in the wide swath mode."""
    return acq.where((F.col("mode") == "IW") & F.array_contains("polarisations", "VV") & F.array_contains("polarisations", "VH"))


def daily(obs: DataFrame, pixels: DataFrame, event: Column | DataFrame, days: int, how: Column, nodata: float = DEFAULTS.nodata) -> DataFrame:
    """``pixel, series``: one value for each day of the antecedent window, oldest first, ``nodata`` where a day has none.

    ``how`` aggregates a day's observations, such as half the sum of half-hourly rates
    or the first value. Days are filled within each pixel's array, so the calendar is
    never joined to the observations.
    """
    events = event
    obs, event, by = _keyed(obs, event)
    key, day = [*by, "pixel"], F.to_date("ts")
    rows = obs.where((day >= F.date_sub(event, days)) & (day < event)).groupBy(*key, day.alias("day")).agg(how.alias("v"))
    found = rows.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("day", "v"))).alias("m"))
    at = F.transform(F.sequence(F.date_sub(event, days), F.date_sub(event, 1)), lambda d: F.coalesce(F.try_element_at(F.col("m"), d), F.lit(nodata)))
    none = F.array_repeat(F.lit(nodata), days)
    return _keyed(pixels.join(found, key, "left"), events)[0].select(*key, F.when(F.col("m").isNull(), none).otherwise(at).alias("series"))


def rain(obs: DataFrame, pixels: DataFrame, event: Column | DataFrame, days: int = 30) -> DataFrame:
    return daily(obs, pixels, event, days, F.sum("value") * 0.5)


def moisture(obs: DataFrame, pixels: DataFrame, event: Column | DataFrame, days: int = 30) -> DataFrame:
    return daily(obs, pixels, event, days, F.min_by("value", F.struct("ts", "value")))


def open_water(cls: Column) -> Column:
    return F.coalesce((cls == 80).cast("tinyint"), F.lit(0).cast("tinyint"))
