"""Captured pages: structured prices, and which pages count as dead or blocked."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewatch.channels import by_channel
from pricewatch.functions.classify import is_blocked_page, is_dead_title, is_gone
from pricewatch.functions.markup import with_structured_price
from pricewatch.functions.once import computed_once


def page_prices(captures: DataFrame) -> DataFrame:
    """Add ``blocked``, ``page_price`` and ``page_currency``; a blocked page holds no price."""
    blocked = is_blocked_page(F.col("page_title"), F.col("html"))
    checked = computed_once(captures, {"blocked": blocked})
    readable = checked.withColumn("__html", F.when(~F.col("blocked"), F.col("html")))
    return with_structured_price(readable, F.col("__html"), "page_price", "page_currency").drop("__html")


def page_states(captures: DataFrame) -> DataFrame:
    """Add ``dead_page``, ``unavailable`` and ``blocked`` by the rules of the row's platform."""
    platform = F.col("platform")
    response = [F.col(c) for c in ("http_status", "requested_url", "final_url")]
    return captures.withColumns(
        {
            "dead_page": by_channel(
                platform, lambda c: c.dead_title(F.col("page_title")), is_dead_title(F.col("page_title"))
            ),
            "unavailable": by_channel(platform, lambda c: c.gone(*response), is_gone(*response)),
            "blocked": is_blocked_page(F.col("page_title"), F.col("html")),
        }
    )
