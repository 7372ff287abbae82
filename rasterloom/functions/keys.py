"""Keys, labels and names as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

UNKNOWN_DATE = "NODATE"


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def activation_key(code: Column, product: Column, date: Column) -> Column:
    """``code_product_date``, with NODATE for a missing or blank date."""
    return F.concat_ws("_", code, product, F.coalesce(blank_to_null(date), F.lit(UNKNOWN_DATE)))


def product_label(kind: Column, monitoring: Column, number: Column) -> Column:
    """``kind_MONITnn`` for a numbered monitoring product, else ``kind_PRODUCT``."""
    monit = F.coalesce(monitoring, F.lit(False)) & (F.coalesce(number, F.lit(0)) > 0)
    return F.when(monit, F.format_string("%s_MONIT%02d", kind, number)).otherwise(F.concat(kind, F.lit("_PRODUCT")))


def aoi_code(number: Column) -> Column:
    return F.format_string("AOI%02d", number)


def safe_word(c: Column) -> Column:
    """Characters that are not of a word, in Unicode's sense, become underscores; those at the ends go."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w]", "_"), r"^_+|_+$", "")


def parent_code(folder: Column) -> Column:
    return F.split_part(folder, F.lit("_"), F.lit(1))


def after_first_slash(path: Column) -> Column:
    return F.regexp_replace(path, r"^[^/]*/", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def code_number(code: Column) -> Column:
    return F.nullif(F.regexp_extract(code, r"EMSR(\d+)", 1), F.lit("")).try_cast("int")


def stamped(stem: Column, event: Column, days: Column) -> Column:
    """``stem_first_last`` of the antecedent window, the event's day left out."""
    day = lambda d: F.date_format(d, "yyyyMMdd")
    return F.concat_ws("_", stem, day(F.date_sub(event, days)), day(F.date_sub(event, 1)))


def band_name(prefix: str, day: Column) -> Column:
    return F.concat_ws("_", F.lit(prefix), F.date_format(day, "yyyyMMdd"))


def squeezed(c: Column) -> Column:
    """Lower case without underscores, dashes and spaces."""
    return F.translate(F.lower(c), "_- ", "")


@F.pandas_udf(StringType())
def _ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def task_name(c: Column, most: int = 70) -> Column:
    """An ASCII task name; Spark has no Unicode decomposition, so that step alone is an Arrow-batched function."""
    return F.substring(F.regexp_replace(_ascii(c), r"[^a-zA-Z0-9._,:;\-]", "_"), 1, most)


def file_of_url(url: Column) -> Column:
    return F.element_at(F.split(F.split_part(url, F.lit("?"), F.lit(1)), "/"), -1)


def absolute_url(url: Column, site: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).when(url.startswith("/"), F.concat(site, url)).otherwise(F.concat(site, F.lit("/"), url))


def codes_of(joined: Column) -> Column:
    """The distinct codes of a dash-joined string; blanks and ``nan`` are none."""
    return F.array_distinct(F.filter(F.split(F.coalesce(joined, F.lit("")), "-"), lambda x: (x != "") & (x != "nan")))


def product_file(name: Column) -> Column:
    """Code, area and product of a file name, null where it is of another form."""
    pattern = r"(EMSR\d+)_([^_]+)_(.+?)_(?:r\d+|v\d+)"
    part = lambda k: F.regexp_extract(name, pattern, k)
    return F.when(name.rlike(pattern), F.struct(part(1).alias("code"), part(2).alias("area"), part(3).alias("product")))
