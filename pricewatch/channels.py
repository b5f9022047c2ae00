"""Channel registry: one entry per retailer, each rule a function of columns.

A new channel is one more ``Channel`` in ``CHANNELS``. Rules are applied to a whole
table by ``by_channel``, which builds one ``when`` per registered channel.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewatch.functions import attributes, classify, identity, price
from pricewatch.functions.text import or_empty, strip


@dataclass(frozen=True)
class Channel:
    """Rules of one retailer.

    A card's price is read either by ``card_amount``, or by the general price reader
    from what ``card_text`` makes of the text.
    """

    key: str
    name: str
    currency: str
    bounds: tuple[float, float] | None
    batch_key: Callable[[Column], Column] = identity.url_key
    canonical_url: Callable[[Column], Column] = identity.url_key
    gone: Callable[[Column, Column, Column], Column] = classify.is_gone
    card_text: Callable[[Column], Column] | None = None
    card_amount: Callable[[Column], Column] | None = None
    brand: Callable[[Column], Column] = attributes.brand_by_word
    size: Callable[[Column], Column] = attributes.size_amazon
    batch_prices: bool = False
    api_prices: bool = False
    min_items: int = 0
    min_coverage: float = 0.0

    def dead_title(self, title: Column) -> Column:
        return classify.is_dead_title(title, self.key)

    def bounded(self, amount: Column) -> Column:
        return price.within(amount, *self.bounds) if self.bounds else amount


CHANNELS = (
    Channel(
        "boulanger", "Boulanger", "EUR", (50, 50_000),
        batch_key=identity.boulanger_key,
        canonical_url=identity.boulanger_url,
        card_amount=price.comma_decimal_amount,
        brand=attributes.brand_by_substring,
        size=attributes.size_boulanger,
        batch_prices=True, min_items=180, min_coverage=0.50,
    ),
    Channel(
        "currys", "Currys", "GBP", (50, 50_000),
        batch_key=identity.currys_key,
        canonical_url=identity.currys_url,
        gone=classify.is_gone_or_redirected,
        card_amount=price.pound_amount,
        brand=attributes.brand_of_slug,
        size=attributes.size_currys_title,
        batch_prices=True, min_items=300, min_coverage=0.55,
    ),
    Channel("amazon", "Amazon", "EUR", None, card_text=lambda text: text),
    Channel(
        "elkjop", "Elkjop", "NOK", (100, 500_000),
        canonical_url=identity.elkjop_url,
        card_text=price.as_kroner,
        brand=attributes.brand_elkjop,
        size=attributes.size_elkjop,
        api_prices=True,
    ),
)


def channel_key(platform: Column) -> Column:
    return F.lower(strip(or_empty(platform)))


def by_channel(platform: Column, rule: Callable[[Channel], Column], default: Column | None = None) -> Column:
    """``rule`` of the row's channel; ``default`` (null) for an unregistered platform."""
    key = channel_key(platform)
    branches = reduce(
        lambda w, channel: w.when(key == channel.key, rule(channel)),
        CHANNELS[1:],
        F.when(key == CHANNELS[0].key, rule(CHANNELS[0])),
    )
    return branches if default is None else branches.otherwise(default)


def batch_key(platform: Column, url: Column) -> Column:
    return by_channel(platform, lambda c: c.batch_key(url), identity.url_key(url))


def is_registered(platform: Column) -> Column:
    return channel_key(platform).isin(*(c.key for c in CHANNELS))


def gate_thresholds(spark: SparkSession) -> DataFrame:
    """One row per channel that publishes batch prices."""
    rows = [(c.name, c.min_items, c.min_coverage) for c in CHANNELS if c.batch_prices]
    return spark.createDataFrame(rows, "platform string, min_items long, min_coverage double")
