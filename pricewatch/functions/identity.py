"""Product identity: batch keys, canonical URLs, ASINs and slugs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pricewatch.fixed_values import (
    RE_ASIN,
    RE_ASIN_IN_URL,
    RE_BOULANGER_REF,
    RE_CURRYS_ID,
    RE_CURRYS_SLUG,
    RE_ELKJOP_SKU,
    SITE_ROOT,
)
from pricewatch.functions.text import first_group, or_empty, strip


def url_key(url: Column) -> Column:
    return strip(or_empty(url))


def boulanger_key(url: Column) -> Column:
    return F.coalesce(first_group(url, RE_BOULANGER_REF), url_key(url))


def currys_key(url: Column) -> Column:
    return F.coalesce(first_group(url, RE_CURRYS_ID), url_key(url))


def elkjop_sku(url: Column) -> Column:
    return first_group(url, RE_ELKJOP_SKU)


def currys_slug(url: Column) -> Column:
    return first_group(url, RE_CURRYS_SLUG)


def asin(item_id: Column, url: Column | None = None) -> Column:
    """A ten-character id, else the id inside a product URL, upper-cased."""
    own = F.when(strip(item_id).rlike(RE_ASIN), strip(item_id))
    found = own if url is None else F.coalesce(own, first_group(url, RE_ASIN_IN_URL))
    return F.upper(found)


def boulanger_url(url: Column) -> Column:
    """Absolute, without the fragment."""
    absolute = F.when(url.startswith("http"), url).otherwise(
        F.concat(F.lit(SITE_ROOT["boulanger"]), url)
    )
    return F.substring_index(absolute, "#", 1)


def currys_url(url: Column) -> Column:
    """Absolute, without the query."""
    absolute = F.when(url.startswith("http"), url).otherwise(
        F.concat(F.lit(SITE_ROOT["currys"]), url)
    )
    return F.substring_index(absolute, "?", 1)


def elkjop_url(url: Column) -> Column:
    """Absolute, without query, fragment and closing slashes."""
    path = F.regexp_replace(or_empty(url), r"[?#].*$", "")
    absolute = (
        F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), path)
        .when(path.startswith("//"), F.concat(F.lit("https:"), path))
        .otherwise(F.concat(F.lit(SITE_ROOT["elkjop"] + "/"), F.ltrim(path, F.lit("/"))))
    )
    return F.rtrim(absolute, F.lit("/"))
