"""Listing cards: validity, merging per product, and card prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewatch.channels import by_channel
from pricewatch.functions import attributes, classify
from pricewatch.functions.once import computed_once
from pricewatch.functions.identity import boulanger_url, currys_url
from pricewatch.functions.price import comma_decimal_amount, pound_amount, with_price, within
from pricewatch.functions.text import blank_to_null, or_empty, strip
from pricewatch.fixed_values import MIN_CARD_TITLE
from pricewatch.operators.dedup import first_seen

DROP_REASONS = ("sponsored", "duplicate", "blank", "no_brand", "no_size", "non_tv")
_ORDER = ["query_no", "page", "pos"]


def card_attributes(cards: DataFrame) -> DataFrame:
    """Add the cleaned id and title with the brand and size a card shows."""
    title = strip(or_empty(F.col("title")))
    size = F.coalesce(
        attributes.size_amazon(title), attributes.size_amazon(or_empty(F.col("size_text")))
    )
    return computed_once(
        cards,
        {
            "asin": F.upper(strip(or_empty(F.col("product_key")))),
            "title": title,
            "brand_raw": attributes.card_brand(F.col("brand"), title),
            "size_hint_inch": size,
            "sponsored": F.coalesce(F.col("sponsored"), F.lit(False)),
        },
    )


def _own_reason() -> Column:
    return (
        F.when((F.col("asin") == "") | (F.col("title") == ""), "blank")
        .when(F.col("brand_raw") == "", "no_brand")
        .when(F.col("size_hint_inch").isNull(), "no_size")
        .when(classify.is_non_tv(F.col("title")), "non_tv")
    )


def read_cards(cards: DataFrame) -> DataFrame:
    """Cards with their attributes, and what ``reasons_among`` needs of each: its own reason and its key."""
    # Blank ids match nothing; keys of their own keep them from meeting in one task.
    key = F.when(F.col("asin") == "", F.concat_ws(" ", F.lit("blank"), *_ORDER)).otherwise(F.col("asin"))
    return computed_once(card_attributes(cards), {"__own": _own_reason(), "__key": key})


def card_reasons(cards: DataFrame) -> DataFrame:
    """Every card with the first reason to drop it, null for the kept one.

    A product counts as held from its first valid card on; later cards of it are
    duplicates whatever they show. ``query_no``, ``page``, ``pos`` give capture order.
    """
    return reasons_among(read_cards(cards))


def reasons_among(shown: DataFrame) -> DataFrame:
    """``card_reasons`` of read cards, which it goes through twice."""
    here = F.struct(*_ORDER)
    valid = ~F.col("sponsored") & F.col("__own").isNull()
    first = shown.filter(valid).groupBy("__key").agg(F.min(here).alias("__first"))
    reason = (
        F.when(F.col("sponsored"), "sponsored")
        .when(F.col("__first").isNotNull() & (here > F.col("__first")), "duplicate")
        .otherwise(F.col("__own"))
    )
    return (
        shown.join(first, "__key", "left")
        .withColumn("reason", reason)
        .drop("__own", "__first", "__key")
    )


def kept_cards(reasons: DataFrame) -> DataFrame:
    return reasons.filter(F.col("reason").isNull())


def filter_reasons(reasons: DataFrame, keys=("query", "page")) -> DataFrame:
    """Counts per drop reason; blank cards are dropped without being counted."""
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in DROP_REASONS if r != "blank"]
    return reasons.groupBy(*keys).agg(
        F.count("*").alias("cards"), F.count_if(F.col("reason").isNull()).alias("kept"), *counts
    )


def first_valid_cards(cards: DataFrame) -> DataFrame:
    """First card per product over page and position; short titles are image links."""
    titled = cards.filter(
        (or_empty(F.col("product_key")) != "")
        & (F.length(strip(or_empty(F.col("title")))) >= MIN_CARD_TITLE)
    )
    return first_seen(titled, ["product_key"], ["page", "pos"])


def merge_links(links: DataFrame, keys: list[str]) -> DataFrame:
    """One card per product from its links: longest title, first price, first address."""
    title = or_empty(F.col("title"))
    return links.groupBy(*keys).agg(
        F.max(F.struct(F.length(title).alias("n"), (-F.col("pos")).alias("p"), title.alias("t")))
        .getField("t")
        .alias("title"),
        or_empty(
            F.min(
                F.when(or_empty(F.col("price_text")) != "", F.struct("pos", "price_text"))
            ).getField("price_text")
        ).alias("price_text"),
        F.min(F.struct("pos", "href")).getField("href").alias("href"),
    )


def merge_longest_card(cards: DataFrame, keys: list[str]) -> DataFrame:
    """Whole record with the longest text; a later card may supply its missing price."""
    text = or_empty(F.col("text"))
    longest = cards.groupBy(*keys).agg(
        F.max(
            F.struct(
                F.length(text).alias("n"),
                (-F.col("pos")).alias("p"),
                F.struct("pos", "href", "title", "text", "price_text").alias("card"),
            )
        )
        .getField("card")
        .alias("__c")
    ).select(*keys, "__c.*")
    unpriced = longest.filter(or_empty(F.col("price_text")) == "").select(
        *keys, F.col("pos").alias("__from")
    )
    later = (
        cards.filter(or_empty(F.col("price_text")) != "")
        .join(unpriced, keys)
        .filter(F.col("pos") > F.col("__from"))
        .groupBy(*keys)
        .agg(F.min(F.struct("pos", "price_text")).getField("price_text").alias("__later"))
    )
    return (
        longest.join(later, keys, "left")
        .withColumn(
            "price_text",
            or_empty(F.coalesce(blank_to_null(F.col("price_text")), F.col("__later"))),
        )
        .drop("__later")
    )


def card_prices(cards: DataFrame) -> DataFrame:
    """Add ``price_local`` by the price-text rule of the card's channel."""
    platform, text = F.col("platform"), F.col("price_text")
    no_text = F.lit(None).cast("string")
    general = by_channel(platform, lambda c: c.card_text(text) if c.card_text else no_text)
    read = with_price(cards, general, "__general", "__unit")
    amount = by_channel(
        platform, lambda c: c.bounded(c.card_amount(text) if c.card_amount else F.col("__general"))
    )
    return computed_once(read, {"price_local": amount}).drop("__general", "__unit")


def best_titles(links: DataFrame, key: str) -> DataFrame:
    """Best-scored name candidate per product, the first on ties."""
    score = classify.title_score(F.col("text"))
    return (
        links.filter(classify.is_title_candidate(F.col("text")))
        .groupBy(key)
        .agg(
            F.max(F.struct(score.alias("s"), (-F.col("pos")).alias("p"), F.col("text").alias("t"))).alias("b")
        )
        .select(key, F.col("b.t").alias("title"), F.col("b.s").alias("score"))
    )


def lowest_price(links: DataFrame, key: str) -> DataFrame:
    """Lowest believable price among the texts of a product."""
    value = within(comma_decimal_amount(F.col("price_text")), 50, 50_000)
    return links.groupBy(key).agg(F.min(value).alias("price_local"))


def boulanger_items(links: DataFrame) -> DataFrame:
    """Link rows to catalogue items, one per canonical address with a usable name."""
    keyed = computed_once(
        links, {"url": boulanger_url(F.col("href")), "text": strip(or_empty(F.col("text")))}
    )
    named = best_titles(keyed, "url").join(lowest_price(keyed, "url"), "url")
    return named.select(
        attributes.brand_by_substring(F.col("title")).alias("brand_raw"),
        F.col("title").alias("raw_text"),
        "url",
        attributes.size_boulanger(F.col("title")).alias("size_hint_inch"),
        "price_local",
    )


def currys_items(cards: DataFrame) -> DataFrame:
    """Cards keyed by slug to catalogue items named after the slug; prices are GBP."""
    slug = F.col("product_key")
    return cards.select(
        attributes.brand_of_slug(slug).alias("brand_raw"),
        attributes.slug_title(slug).alias("raw_text"),
        currys_url(or_empty(F.col("href"))).alias("url"),
        attributes.size_currys(slug, F.col("title")).alias("size_hint_inch"),
        within(pound_amount(or_empty(F.col("price_text"))), 50, 50_000).alias("price_local"),
    )
