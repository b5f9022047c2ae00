"""Schemas of captured tables and the small literal dimensions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from pricewatch.fixed_values import CANARIES, CATALOG_MARKETS, FX_RATE_DATE, MARKETS, UNITS_PER_EUR

LINKS = (
    "brand string, sku string, model string, country string, platform string, url string, "
    "active string, revision string"
)
PRICE_LOG = (
    "obs_date date, obs_time string, brand string, product_name string, country string, "
    "platform string, price double, currency string, provenance string, status string, trend string"
)
SNAPSHOT = "platform string, batch_key string, price double, currency string"
CARDS = (
    "platform string, country string, query string, query_kind string, page int, pos int, "
    "product_key string, href string, title string, brand string, price_text string, text string, "
    "size_text string, sponsored boolean, variant_hint boolean, filter_year int"
)
CATALOG_ITEMS = (
    "brand_raw string, raw_text string, url string, size_hint_inch double, price_hint_eur double, "
    "price_local double, currency string, price_eur double, platform string, country string, "
    "scraped_at timestamp, asin string, elkjop_sku string, model_year int, filter_year int, "
    "source_brand string, fx_rate_date date"
)
CAPTURES = (
    "requested_url string, final_url string, http_status int, page_title string, html string, "
    "captured_at timestamp"
)
RUN_LOGS = "run_id string, revision string, run_date date, line_no long, line string"

HIT = (
    "struct<articleNumber:string,objectID:string,brand:string,title:string,name:string,"
    "manufacturerArticleNumber:string,productUrl:string,urlB2C:string,"
    "price:struct<amount:string,currency:string>,attributes:map<string,string>,"
    "shortDescription:string,isOnline:boolean,isBuyableOnline:boolean,onlineSalesStatus:string>"
)
SEARCH_RESPONSE = f"struct<results:array<struct<nbHits:int,nbPages:int,hits:array<{HIT}>>>>"
PRICE_RESPONSE = (
    "array<struct<result:struct<data:struct<price:struct<currency:string,current:array<string>>,"
    "sellability:struct<isDisabled:boolean,isDiscontinued:boolean>>>>>"
)


def fx_rates(spark: SparkSession) -> DataFrame:
    rows = [(code, Decimal(units), FX_RATE_DATE) for code, units in UNITS_PER_EUR.items()]
    return spark.createDataFrame(rows, "currency string, units_per_eur decimal(10,6), rate_date string")


def markets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MARKETS, "market string, expected_currency string, search_word string, location_required boolean"
    )


def canaries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CANARIES, "market string, asin string, known_price double")


def catalog_markets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOG_MARKETS, "registry_key string, platform string, country string")
