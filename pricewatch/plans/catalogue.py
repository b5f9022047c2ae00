"""Catalogue snapshots from cards, links and API responses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pricewatch.fixed_values import (
    CATALOG_MARKETS,
    FX_RATE_DATE,
    MARKET_SITES,
    MARKETS,
    RE_ELKJOP_SKU,
    RECOVERY_BUDGET,
    SEEDS_PER_FAMILY,
    SERIES_RESCUE_BUDGET,
    TARGET_YEARS,
    VARIANT_SEED_BUDGET,
    VARIANTS_PER_SEED,
)
from pricewatch.functions import attributes, classify
from pricewatch.functions.identity import elkjop_url
from pricewatch.functions.once import computed_once
from pricewatch.functions.price import to_eur, with_market_price
from pricewatch.functions.text import blank_to_null, or_empty, strip
from pricewatch.operators import cards as card_ops
from pricewatch.operators import match, rank, reconcile
from pricewatch.schemas import canaries, markets
from pricewatch.session import spread, written
from pricewatch.sinks import write_catalog
from pricewatch.sources.api import api_hits, api_pages, hit_items


class CatalogueRejected(RuntimeError):
    """A completeness gate failed; nothing may be written."""


def market_items(cards: DataFrame, currency: str) -> DataFrame:
    """Kept search cards of one market as catalogue items with family columns.

    A later card of a kept product adds nothing but its variant hint. Each card is read once.
    """
    judged = card_ops.reasons_among(written(card_ops.read_cards(cards), "read-cards"))
    kept = with_market_price(spread(card_ops.kept_cards(judged)), F.col("price_text"), F.lit(currency))
    again = judged.filter(F.col("reason") == "duplicate").select("asin", "variant_hint")
    items = kept.select(
        "asin",
        "pos",
        "brand_raw",
        F.col("title").alias("raw_text"),
        "size_hint_inch",
        "variant_hint",
        "price_local",
        "currency",
        "price_eur",
        F.when(~F.col("currency").isin("", "EUR"), FX_RATE_DATE).alias("fx_rate_date"),
    )
    return match.flag_seen(again, match.family_columns(items))


@dataclass(frozen=True)
class Budgets:
    """How much one round of look-ups may ask for."""

    rescue: int = SERIES_RESCUE_BUDGET
    recovery: int = RECOVERY_BUDGET
    seeds: int = VARIANT_SEED_BUDGET
    per_family: int = SEEDS_PER_FAMILY
    per_seed: int = VARIANTS_PER_SEED


def lookups(items: DataFrame, history: DataFrame, budgets: Budgets = Budgets()) -> dict[str, DataFrame]:
    """What to look up next: rescue searches, missing sizes and variant seeds."""
    candidates = items.filter(classify.is_variant_candidate(F.col("raw_text"), F.col("variant_hint")))
    return {
        "rescue": rank.series_rescue(items, budgets.rescue),
        "recovery": rank.recovery_pick(match.missing_sizes(history, items), budgets.recovery),
        "seeds": rank.variant_seeds(candidates, budgets.seeds, budgets.per_family),
    }


@dataclass(frozen=True)
class LookedUp:
    """Captured answers to look-ups: cards by search text, and detail pages by ASIN.

    ``searches`` are cards whose ``query`` is the search text. ``details`` have asin, title,
    price_text and refs, the siblings that the page names (asin and text).
    """

    searches: DataFrame
    details: DataFrame


def _as_items(found: DataFrame, currency: str) -> DataFrame:
    """Looked-up products (asin, pos, brand_raw, raw_text, size_hint_inch, price_text) as catalogue items."""
    priced = with_market_price(found, F.col("price_text"), F.lit(currency)).withColumn(
        "fx_rate_date", F.when(~F.col("currency").isin("", "EUR"), FX_RATE_DATE)
    )
    hinted = priced if "variant_hint" in found.columns else priced.withColumn("variant_hint", F.lit(False))
    columns = [c for c in ITEM_COLUMNS if c not in ("brand_key", "series", "size")]
    return match.family_columns(hinted.select(*columns)).select(*ITEM_COLUMNS)


def _detail_items(wanted: DataFrame, details: DataFrame, currency: str) -> DataFrame:
    """Valid detail pages of the wanted products; the brand falls back to the one known before."""
    title = strip(or_empty(F.col("title")))
    known = wanted.select("asin", "pos", F.col("brand_raw").alias("known_brand"))
    # Generated, text rules read the joined titles only; filters on them would move to all details.
    found = spread(computed_once(known.join(details.select("asin", "title", "price_text"), "asin"), {"title": title}))
    brand = F.coalesce(blank_to_null(attributes.brand_by_word(F.col("title"))), F.col("known_brand"))
    size = attributes.size_amazon(F.col("title"))
    read = {"brand_raw": brand, "size_hint_inch": size, "__other": classify.is_non_tv(F.col("title"))}
    valid = computed_once(found, read).filter(
        (F.col("title") != "") & F.col("size_hint_inch").isNotNull() & ~F.col("__other")
    )
    return _as_items(valid.withColumnRenamed("title", "raw_text"), currency)


#: Columns of a market item with its family.
ITEM_COLUMNS = (
    "asin", "pos", "brand_raw", "raw_text", "size_hint_inch", "variant_hint", "price_local", "currency", "price_eur",
    "fx_rate_date", "brand_key", "series", "size",
)


def follow_up(items: DataFrame, history: DataFrame, found: LookedUp, currency: str, budgets: Budgets = Budgets(),
              rounds: int | None = 1) -> DataFrame:
    """Items with all that rescue searches, missing sizes and variants add.

    Each round asks three things in turn, each of the items held so far: searches for the
    series with the fewest sizes, products of earlier catalogues whose size is missing, and
    the siblings named by the detail pages of variant seeds. Answers that are held already
    add nothing. What has been asked is not asked again, so with ``rounds`` None the loop
    goes on until a round asks for nothing new. Held items and questions are written after
    each step; the driver sees only whether a question is left.
    """
    held = written(items.select(*ITEM_COLUMNS), "held-items")
    history = written(history, "earlier-items")
    # A question leaves the candidates once it was asked, so the picks move on.
    asked = {name: None for name in ("rescue", "recovery", "seeds")}
    done = 0

    def fresh(name: str, candidates: DataFrame, keys: list[str]) -> DataFrame:
        return candidates if asked[name] is None else candidates.join(asked[name], keys, "left_anti")

    def remember(name: str, picked: DataFrame, keys: list[str]) -> DataFrame:
        picked = written(picked, f"asked-{name}")
        known = picked.select(*keys)
        asked[name] = written(known if asked[name] is None else asked[name].union(known), f"all-{name}")
        return picked

    def add(more: DataFrame) -> None:
        nonlocal held
        first = F.min_by(F.struct(*ITEM_COLUMNS), "pos").alias("i")
        new = match.unseen(more, held).groupBy("asin").agg(first).select("i.*")
        held = written(held.unionByName(new), "held-items")

    while rounds is None or done < rounds:
        done += 1
        families = remember("rescue", rank.series_rescue(fresh("rescue", held, match.FAMILY), budgets.rescue), match.FAMILY)
        cards = spread(found.searches.join(families.select("query").distinct(), "query", "left_semi"))
        add(market_items(cards, currency).select(*ITEM_COLUMNS))

        missing = match.unseen(match.missing_sizes(fresh("recovery", history, ["asin"]), held), held)
        picked = rank.recovery_pick(written(missing, "missing-items"), budgets.recovery)
        previous = remember("recovery", picked, ["asin"])
        add(_detail_items(previous, found.details, currency))

        candidates = held.filter(classify.is_variant_candidate(F.col("raw_text"), F.col("variant_hint")))
        seeds = rank.variant_seeds(fresh("seeds", candidates, ["asin"]), budgets.seeds, budgets.per_family)
        seeds = remember("seeds", seeds, ["asin"])
        named = seeds.select("asin", F.col("pick_no").alias("seed_pos"), "brand_raw").join(found.details.select("asin", "refs"), "asin")
        siblings = match.variant_expand(named, held, found.details.select("asin", "title", "price_text"), budgets.per_seed)
        add(_as_items(siblings.withColumn("pos", F.lit(0).cast(held.schema["pos"].dataType)), currency))

        if families.isEmpty() and previous.isEmpty() and seeds.isEmpty():
            break
    return held


def api_verdicts(responses: DataFrame) -> dict[str, DataFrame]:
    """Every gate of an API catalogue; an empty table of violations means it passed."""
    return _verdicts(api_pages(responses), api_hits(responses))


def _verdicts(pages: DataFrame, hits: DataFrame) -> dict[str, DataFrame]:
    required = reconcile.required_brands(hits.sparkSession)
    return {
        "page_drift": reconcile.page_drift(pages).filter(~F.col("stable")),
        "invalid_hit": reconcile.invalid_hits(hits),
        "duplicate_sku": reconcile.duplicate_skus(hits),
        "incomplete": reconcile.completeness(pages, hits).filter(~F.col("complete")),
        "cross_year_sku": reconcile.cross_year_skus(hits),
        "missing_brand": reconcile.missing_brands(hits, required),
    }


def api_items(responses: DataFrame) -> DataFrame:
    """Catalogue items of an API capture; raises when any gate finds a violation.

    The responses are built once and their hits parsed once; gates and items read the written
    rows. All gates are one job of a few rows, and the first broken one is named.
    """
    responses = written(responses, "api-responses")
    pages, hits = written(api_pages(responses), "api-pages"), written(api_hits(responses), "api-hits")
    broken = {r["gate"] for r in reconcile.api_gates(pages, hits).where("violations > 0").collect()}
    for gate in reconcile.API_GATES:
        if gate in broken:
            raise CatalogueRejected(gate)
    return hit_items(hits)


@dataclass(frozen=True)
class Listing:
    """A captured listing: cards (year, page, pos, product_key, href, title, text, price_text), the range text
    of each page (year, page, range_text), and prices of detail pages (product_key, price, currency)."""

    cards: DataFrame
    ranges: DataFrame
    details: DataFrame


def listing_items(listing: Listing) -> DataFrame:
    """Catalogue items of a captured listing; raises when a page or a year is not whole."""
    cards = written(listing.cards, "listing-cards")
    on_page = card_ops.merge_longest_card(cards, ["year", "page", "product_key"])
    on_page = written(on_page.withColumn("product_key", or_empty(F.col("product_key"))), "listing-products")
    if not reconcile.listing_gates(listing.ranges, on_page).where(~F.col("passed")).isEmpty():
        raise CatalogueRejected("listing")
    # A product that a later page shows again is the one of that page.
    last = F.max(F.struct("page", F.struct("href", "title", "text", "price_text").alias("card"))).alias("last")
    products = on_page.where("product_key <> ''").groupBy(F.col("year").alias("filter_year"), "product_key").agg(last)
    priced = match.fill_missing_price(products.select("filter_year", "product_key", "last.card.*"), listing.details)
    raw = F.concat_ws(" ", blank_to_null(F.col("title")), blank_to_null(F.col("text")))
    read = computed_once(
        priced.withColumn("raw_text", strip(raw)),
        {
            "brand_raw": attributes.brand_elkjop(F.col("raw_text")),
            "model_year": attributes.model_year(F.col("raw_text"), F.col("filter_year")),
            "url": elkjop_url(or_empty(F.col("href"))),
        },
    )
    price_eur = to_eur(F.col("price_local"), F.lit("NOK"))
    wanted = (F.col("brand_raw") != "") & F.col("model_year").isin(*TARGET_YEARS) & F.col("url").rlike(RE_ELKJOP_SKU)
    return read.where(wanted).select(
        "brand_raw", "raw_text", "url", attributes.size_elkjop(F.col("raw_text")).alias("size_hint_inch"), "price_local",
        F.lit("NOK").alias("currency"), price_eur.alias("price_hint_eur"), price_eur.alias("price_eur"),
        F.lit(FX_RATE_DATE).alias("fx_rate_date"), F.col("product_key").alias("elkjop_sku"), "filter_year", "model_year",
        attributes.source_brand_elkjop(F.col("raw_text")).alias("source_brand"),
    )


def boulanger_rows(links: DataFrame) -> DataFrame:
    """Listing links (href, text, price_text, pos) as catalogue rows; the price is a hint."""
    return card_ops.boulanger_items(links).withColumnRenamed("price_local", "price_hint_eur")


def currys_rows(links: DataFrame) -> DataFrame:
    """Listing links keyed by slug as catalogue rows; the hint keeps its pounds."""
    merged = card_ops.merge_links(links, ["product_key"])
    return card_ops.currys_items(merged).withColumnRenamed("price_local", "price_hint_eur")


def amazon_rows(cards: DataFrame, market: str, anchors: DataFrame | None = None, found: LookedUp | None = None,
                history: DataFrame | None = None, budgets: Budgets = Budgets(), rounds: int | None = 1) -> DataFrame:
    """Search cards of one market as catalogue rows, with the follow-up where look-ups are given.

    Rejected when no plain card shows a plausible price in the market's currency, or when
    looked-up anchors (asin, price, currency) are given and none is near its known price.
    """
    spark = cards.sparkSession
    cards = written(spread(cards), "market-cards")
    known = markets(spark).filter(F.col("market") == market)
    shown = match.search_currency_canary(cards.withColumn("market", F.lit(market)), known)
    if shown.filter("passed").isEmpty():
        raise CatalogueRejected("search_currency_canary")
    if anchors is not None:
        band = match.canary_band(anchors.withColumn("market", F.lit(market)), canaries(spark), known)
        if band.filter("passed").isEmpty():
            raise CatalogueRejected("canary_band")
    currency = next(row[1] for row in MARKETS if row[0] == market)
    items = market_items(cards, currency)
    if found is not None:
        earlier = items.limit(0) if history is None else history
        items = follow_up(items, earlier, found, currency, budgets, rounds)
    return items.withColumns(
        {
            "url": F.concat(F.lit(f"{MARKET_SITES[market]}/dp/"), F.col("asin")),
            "price_hint_eur": F.col("price_eur"),
        }
    )


def elkjop_rows(responses: DataFrame | None, listing: Listing | None = None) -> DataFrame:
    """The API's items where all its gates pass, else those of the listing, which has gates of its own."""
    if responses is not None:
        try:
            return api_items(responses)
        except CatalogueRejected:
            if listing is None:
                raise
    if listing is None:
        raise CatalogueRejected("no capture")
    return listing_items(listing)


def write_catalogue(rows: DataFrame, registry_key: str, scraped_at: Column, path: str) -> bool:
    """Write the rows of one registered catalogue as its snapshot; false when there are none."""
    _, platform, country = next(entry for entry in CATALOG_MARKETS if entry[0] == registry_key)
    full = written(
        rows.withColumns({"platform": F.lit(platform), "country": F.lit(country), "scraped_at": scraped_at}), "catalogue"
    )
    if full.isEmpty():
        return False
    write_catalog(full, path)
    return True


def catalogue_job(captured: dict[str, Callable[[], DataFrame]], scraped_at: Column, path: str) -> dict[str, str]:
    """Build and write each catalogue by its registry key; the outcome of each.

    A rejected or empty catalogue writes nothing and does not stop the others.
    """
    outcomes = {}
    for key, rows in captured.items():
        try:
            outcomes[key] = "written" if write_catalogue(rows(), key, scraped_at, path) else "empty"
        except CatalogueRejected as rejected:
            outcomes[key] = f"rejected: {rejected}"
    return outcomes
