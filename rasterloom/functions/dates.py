"""Dates in texts, file names and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterloom.functions.keys import UNKNOWN_DATE, blank_to_null

# The phrases that introduce a map's date, the most telling first.
DAY = r"(\d{1,2}[/.]?\d{1,2}[/.]?\d{4})"
PHRASES = (
    r"situation\s+as\s+of\s+",
    r"situation\s+au\s+",
    r"situazione\s+al\s+",
    r"stand\s+vom\s+",
    r"flood\s*[-–]\s*situation\s+as\s+of\s+",
    r"flood\s*[-–]\s*",
    r"as\s+of\s+",
)


def parsed_day(raw: Column) -> Column:
    """``YYYYMMDD`` of a day written D/M/Y, M/D/Y or Y/M/D with slashes or dots; null if it is none."""
    s = F.replace(raw, F.lit("."), F.lit("/"))
    day = F.coalesce(*(F.try_to_date(s, f) for f in ("d/M/yyyy", "M/d/yyyy", "yyyy/M/d")))
    return F.date_format(day, "yyyyMMdd")


def map_day(text: Column) -> Column:
    """The first phrase whose first hit is a day decides; failing all, the first token that is one."""
    hits = [parsed_day(blank_to_null(F.regexp_extract(text, f"(?i){p}{DAY}", 1))) for p in PHRASES]
    tokens = F.transform(F.regexp_extract_all(text, F.lit(r"\d{1,2}[/.]\d{1,2}[/.]\d{4}"), F.lit(0)), parsed_day)
    return F.coalesce(*hits, F.get(F.filter(tokens, lambda x: x.isNotNull()), F.lit(0)))


def suffix_day(folder: Column) -> Column:
    """The date that ends a folder's name."""
    return F.try_to_date(F.nullif(F.regexp_extract(folder, r"_(\d{8})$", 1), F.lit("")), "yyyyMMdd")


def same_day(day: Column, year: Column) -> Column:
    """That day in another year; February 29 has none in common years."""
    return F.try_to_date(F.format_string("%04d%02d%02d", year, F.month(day), F.day(day)), "yyyyMMdd")


def fallback_year(day: Column) -> Column:
    """The year whose season stands in: the next one up to 2024, then the one before."""
    return F.when(F.year(day) <= 2024, F.year(day) + 1).otherwise(F.year(day) - 1)


def event_day(pdf: Column, delivered: Column) -> Column:
    """From the map, else the delivery, else NODATE."""
    return F.coalesce(blank_to_null(pdf), blank_to_null(delivered), F.lit(UNKNOWN_DATE))


def delivery_day(iso: Column) -> Column:
    return F.date_format(F.try_to_timestamp(F.regexp_replace(iso, "Z$", "+00:00")), "yyyyMMdd")


def antecedent_days(event: Column, days: Column | int) -> Column:
    """The window's days, oldest first, the event's own left out."""
    n = F.lit(days) if isinstance(days, int) else days
    return F.sequence(F.date_sub(event, n), F.date_sub(event, 1))
