"""Watch list: the products to price, with their addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewatch.fixed_values import ACTIVE_WORDS, DEFAULT_COUNTRY
from pricewatch.functions.text import blank_to_null, or_empty, strip
from pricewatch.sources.csv_files import read_csv_by_header

_TEXT_COLUMNS = ("brand", "sku", "model", "country", "platform", "url")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Header-driven CSV; every column is text and the byte-order mark is dropped."""
    return read_csv_by_header(spark, path).drop("file_mtime")


def _is_active(df: DataFrame) -> Column:
    """A missing column means active, a blank cell does not."""
    if "active" not in df.columns:
        return F.lit(True)
    return F.lower(strip(or_empty(F.col("active")))).isin(*ACTIVE_WORDS)


def _cell(df: DataFrame, name: str) -> Column:
    return strip(or_empty(F.col(name))) if name in df.columns else F.lit("")


def active_links(raw: DataFrame) -> DataFrame:
    """Active rows with an address: brand, product_name, country, platform, url."""
    cells = {name: _cell(raw, name) for name in _TEXT_COLUMNS}
    name_or_model = F.when(cells["sku"] != "", cells["sku"]).otherwise(cells["model"])
    product = F.when(F.lower(cells["platform"]) == "elkjop", cells["model"]).otherwise(name_or_model)
    country = (
        F.upper(strip(F.coalesce(blank_to_null(F.col("country")), F.lit(DEFAULT_COUNTRY))))
        if "country" in raw.columns
        else F.lit(DEFAULT_COUNTRY)
    )
    return raw.filter(_is_active(raw) & (cells["url"] != "")).select(
        cells["brand"].alias("brand"),
        product.alias("product_name"),
        country.alias("country"),
        cells["platform"].alias("platform"),
        cells["url"].alias("url"),
    )


def links_audit(raw: DataFrame) -> DataFrame:
    """One row of counts; ``usable_ok`` is false when rows are active but none has an address."""
    active, has_url = _is_active(raw), _cell(raw, "url") != ""
    counts = raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(active).alias("active_rows"),
        F.count_if(active & ~has_url).alias("active_without_url"),
        F.count_if(active & has_url).alias("usable_rows"),
    )
    return counts.withColumn("usable_ok", ~((F.col("active_rows") > 0) & (F.col("usable_rows") == 0)))


def brand_candidates(raw: DataFrame) -> DataFrame:
    """Active rows of every mapping revision, keyed as the run log names products.

    No default country here, and the SKU name wins on every platform.
    """
    sku = F.coalesce(blank_to_null(F.col("sku")), F.col("model"), F.lit(""))
    return raw.filter(_is_active(raw)).select(
        "revision",
        strip(sku).alias("product_name"),
        F.upper(_cell(raw, "country")).alias("country"),
        _cell(raw, "platform").alias("platform"),
        _cell(raw, "brand").alias("brand"),
    )


BRAND_KEY = ("revision", "product_name", "country", "platform")


def brand_map(raw: DataFrame) -> DataFrame:
    """One brand per key and revision, with the number of different brands seen."""
    return brand_candidates(raw).groupBy(*BRAND_KEY).agg(
        F.min("brand").alias("brand"),
        F.count_distinct("brand").alias("brands"),
    )
