"""Fields of run-log lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pricewatch.fixed_values import (
    RE_LOG_BATCH,
    RE_LOG_PAGE,
    RE_LOG_PRODUCT,
    RE_LOG_TIMESTAMP,
)
from pricewatch.functions.text import or_empty


def line_kind(line: Column) -> Column:
    """PRODUCT, PRICE, UNNAMED (a price without identity) or OTHER; the first test wins."""
    return (
        F.when(line.rlike(RE_LOG_PRODUCT), "PRODUCT")
        .when(line.rlike(RE_LOG_BATCH), "PRICE")
        .when(line.rlike(RE_LOG_PAGE), "UNNAMED")
        .otherwise("OTHER")
    )


def product_fields(line: Column) -> dict[str, Column]:
    """Fields of a line known to name a product."""
    return {
        "country": F.regexp_extract(line, RE_LOG_PRODUCT, 1),
        "product_name": F.regexp_extract(line, RE_LOG_PRODUCT, 2),
        "platform": F.regexp_extract(line, RE_LOG_PRODUCT, 3),
    }


def price_fields(line: Column) -> dict[str, Column]:
    """Fields of a line known to hold a batch price."""
    return {
        "currency": F.regexp_extract(line, RE_LOG_BATCH, 1),
        "price": F.regexp_extract(line, RE_LOG_BATCH, 2).try_cast("double"),
        "logged_trend": F.regexp_extract(line, RE_LOG_BATCH, 3),
    }


def line_timestamp(line: Column) -> Column:
    return or_empty(F.regexp_extract(line, RE_LOG_TIMESTAMP, 1))


def time_of(timestamp: Column) -> Column:
    """``HH:mm:ss`` of a log timestamp; midnight when there is none."""
    clock = F.rtrim(
        F.substring_index(F.substring_index(timestamp, "T", -1), ".", 1), F.lit("Z")
    )
    return F.when(timestamp == "", "00:00:00").otherwise(clock)
