"""Semi-structured inputs: product pages in JSON, listing pages in HTML, text blocks of maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.functions import keys
from rasterloom.functions.dates import delivery_day

PRODUCTS = "struct<results:array<struct<aois:array<struct<number:int,name:string,products:array<struct<type:string,monitoring:boolean,monitoringNumber:int,downloadPath:string,version:struct<deliveryTime:string>>>>>>>>"
ACTIVATIONS = "struct<results:array<struct<code:string,name:string,activationTime:string,category:string,countries:array<string>,n_products:int>>,next:string>"
AREA = r"(?i)\bAOI\s*0*(\d+)\b"


def products(pages: DataFrame, code: str = "code", body: str = "body") -> DataFrame:
    """One row for each product that can be downloaded: ``code, aoi, aoi_name, product, url, delivered``."""
    x = pages.select(F.col(code).alias("code"), F.from_json(body, PRODUCTS).alias("j")).select("code", F.explode("j.results").alias("r"))
    x = x.select("code", F.explode("r.aois").alias("a")).select("code", "a.number", "a.name", F.explode("a.products").alias("p"))
    x = x.where(F.length(F.coalesce("p.downloadPath", F.lit(""))) > 0)
    return x.select(
        "code",
        keys.aoi_code(F.col("number")).alias("aoi"),
        keys.safe_word(F.col("name")).alias("aoi_name"),
        keys.product_label(F.col("p.type"), F.col("p.monitoring"), F.col("p.monitoringNumber")).alias("product"),
        F.col("p.downloadPath").alias("url"),
        delivery_day(F.col("p.version.deliveryTime")).alias("delivered"),
    )


def category_name(category: Column) -> Column:
    """A category that is an object with a name, or the name itself."""
    return F.coalesce(F.get_json_object(category, "$.name"), category)


def short_names(countries: Column) -> Column:
    return F.transform(countries, lambda c: F.coalesce(F.get_json_object(c, "$.short_name"), c))


def activations(pages: DataFrame, first: str, last: str, body: str = "body") -> DataFrame:
    """Flood activations between two days, blanks out: ``code, name, day, category, countries, n_products``."""
    x = pages.select(F.explode(F.from_json(body, ACTIVATIONS)["results"]).alias("r")).select("r.*")
    day = F.substring("activationTime", 1, 10)
    kind = category_name(F.col("category"))
    x = x.where(F.lower(kind).contains("flood") & day.between(first, last))
    return x.select("code", "name", day.alias("day"), kind.alias("category"), F.array_join(short_names(F.col("countries")), ", ").alias("countries"), "n_products")


def elements(html: Column) -> Column:
    """Paragraphs, headings and links of a page in document order, scripts, styles and comments left out."""
    clean = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    return F.regexp_extract_all(clean, F.lit(r"(?is)<(?:h[1-6]|li)[^>]*>|<a\s[^>]*>"), F.lit(0))


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key, pos, href`` of all links."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'<a href="([^"]*)"'), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("pos", "href"))


def carried(rows: DataFrame, page: str, pos: str, heading: Column) -> DataFrame:
    """Rows with the last heading at or before them on their page; before the first one none."""
    w = Window.partitionBy(page).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("heading", F.last(heading, ignorenulls=True).over(w))


def product_links(rows: DataFrame, code: str = "code", href: str = "href", pos: str = "pos") -> DataFrame:
    """Maps and vector archives of a code's page, by area and product: the last link of each kind wins."""
    name = keys.file_of_url(F.col(href))
    x = rows.where(F.col(href).contains(F.col(code)) & (F.lower(name).endswith(".pdf") | F.lower(name).endswith("vector.zip")))
    x = x.withColumn("f", keys.product_file(name)).where("f IS NOT NULL")
    pdf = F.lower(name).endswith(".pdf")
    return x.groupBy(F.col("f.code").alias("code"), F.col("f.area").alias("area"), F.col("f.product").alias("product")).agg(
        F.max_by(F.when(pdf, F.col(href)), F.when(pdf, F.col(pos))).alias("pdf"), F.max_by(F.when(~pdf, F.col(href)), F.when(~pdf, F.col(pos))).alias("vector")
    )


def map_text(blocks: Column) -> Column:
    """The blocks of a map's pages in one line each, between bars; empty ones left out."""
    flat = F.transform(blocks, lambda b: F.regexp_replace(F.regexp_replace(b, r"\n", " "), r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(flat, lambda b: b != ""), " | ")
