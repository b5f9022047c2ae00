"""Captured API responses, one row per page or product, flattened to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewatch.fixed_values import FX_RATE_DATE
from pricewatch.functions.attributes import (
    business_brand,
    distinct_parts,
    facet_size,
    facet_source_brand,
    facet_year,
)
from pricewatch.functions.identity import elkjop_url
from pricewatch.functions.price import to_eur, within
from pricewatch.functions.text import blank_to_null, or_empty, strip, to_number
from pricewatch.schemas import PRICE_RESPONSE, SEARCH_RESPONSE

API_PRICE_RANGE = (100, 500_000)


def api_pages(responses: DataFrame) -> DataFrame:
    """Declared totals and number of hits of each response page."""
    parsed = responses.withColumn("__r", F.from_json("body", SEARCH_RESPONSE)["results"][0])
    return parsed.select(
        "year",
        "page_index",
        F.coalesce(F.col("__r.nbHits"), F.lit(0)).alias("nb_hits"),
        F.coalesce(F.col("__r.nbPages"), F.lit(0)).alias("nb_pages"),
        F.coalesce(F.size("__r.hits"), F.lit(0)).alias("page_hits"),
    )


def api_hits(responses: DataFrame) -> DataFrame:
    """One typed row per hit, numbered within its page."""
    parsed = responses.withColumn("__r", F.from_json("body", SEARCH_RESPONSE)["results"][0])
    hits = parsed.select("year", "page_index", F.posexplode("__r.hits").alias("pos", "hit"))
    name = F.coalesce(blank_to_null(F.col("hit.title")), F.col("hit.name"))
    return hits.select(
        "year",
        "page_index",
        "pos",
        strip(or_empty(F.coalesce(blank_to_null(F.col("hit.articleNumber")), F.col("hit.objectID")))).alias("sku"),
        F.col("hit.brand").alias("brand"),
        facet_source_brand(F.col("hit.brand")).alias("source_brand"),
        facet_year(F.col("hit.attributes")).alias("facet_year"),
        facet_size(F.col("hit.attributes"), name).alias("size_hint_inch"),
        elkjop_url(F.coalesce(blank_to_null(F.col("hit.productUrl")), F.col("hit.urlB2C"))).alias("url"),
        distinct_parts(
            F.col("hit.title"),
            F.col("hit.name"),
            F.col("hit.manufacturerArticleNumber"),
            F.col("hit.shortDescription"),
        ).alias("raw_text"),
        to_number(F.col("hit.price.amount")).alias("amount"),
        F.upper(or_empty(F.col("hit.price.currency"))).alias("currency"),
    )


def hit_items(hits: DataFrame) -> DataFrame:
    """Catalogue columns of valid hits; prices are NOK."""
    price = F.when(F.col("currency") == "NOK", within(F.col("amount"), *API_PRICE_RANGE))
    return hits.select(
        business_brand(F.col("source_brand")).alias("brand_raw"),
        "raw_text",
        "url",
        "size_hint_inch",
        price.alias("price_local"),
        F.lit("NOK").alias("currency"),
        to_eur(price, F.lit("NOK")).alias("price_hint_eur"),
        to_eur(price, F.lit("NOK")).alias("price_eur"),
        F.lit(FX_RATE_DATE).alias("fx_rate_date"),
        F.col("sku").alias("elkjop_sku"),
        F.col("year").alias("filter_year"),
        F.col("year").alias("model_year"),
        "source_brand",
    )


def api_prices(responses: DataFrame) -> DataFrame:
    """Product price responses to ``(sku, price, currency)``; null unless sellable, in NOK and range."""
    data = F.from_json("body", PRICE_RESPONSE)
    kept = [c for c in ("captured_at",) if c in responses.columns]
    parsed = responses.select("sku", *kept, F.get(data, F.lit(0))["result"]["data"].alias("d"))
    value = to_number(F.get(F.col("d.price.current"), F.lit(0)))
    blocked = F.coalesce(F.col("d.sellability.isDisabled"), F.lit(False)) | F.coalesce(
        F.col("d.sellability.isDiscontinued"), F.lit(False)
    )
    sellable = (F.upper(or_empty(F.col("d.price.currency"))) == "NOK") & ~blocked
    price = F.when(sellable, within(value, *API_PRICE_RANGE))
    return parsed.select(
        "sku", *kept, price.alias("price"), F.when(price.isNotNull(), "NOK").alias("currency")
    )
