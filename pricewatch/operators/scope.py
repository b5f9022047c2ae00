"""Which rows a run looks at."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from pricewatch.channels import channel_key, is_registered
from pricewatch.fixed_values import (
    FACET_BRANDS,
    FACET_TAXONOMY,
)


def scope_words(text: str) -> set[str]:
    """Comma-separated whitelist; an empty one means everything."""
    return {word.strip().lower() for word in text.split(",") if word.strip()}


def in_channels(rows: DataFrame, whitelist: str = "") -> DataFrame:
    words = scope_words(whitelist)
    return rows.filter(channel_key(F.col("platform")).isin(*sorted(words))) if words else rows


def in_markets(markets: DataFrame, whitelist: str = "") -> DataFrame:
    """Match by registry key, platform, or platform_country."""
    words = sorted(scope_words(whitelist))
    if not words:
        return markets
    names = (
        F.lower("registry_key"),
        F.lower("platform"),
        F.lower(F.concat_ws("_", "platform", "country")),
    )
    return markets.filter(reduce(or_, (name.isin(*words) for name in names)))


def runnable(links: DataFrame) -> DataFrame:
    return links.filter(is_registered(F.col("platform")))


def skipped_platforms(links: DataFrame) -> DataFrame:
    return (
        links.filter(~is_registered(F.col("platform")))
        .groupBy("platform")
        .agg(F.count("*").alias("skipped"))
    )


def facet_filter(products: DataFrame, year: int, brands=FACET_BRANDS, taxonomy: str = FACET_TAXONOMY) -> DataFrame:
    """Products of one year, the facet brands and one taxonomy node."""
    return products.filter(
        (F.col("facet_year") == year)
        & F.col("brand").isin(*brands)
        & (F.col("taxonomy") == taxonomy)
    )
