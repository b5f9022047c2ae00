"""Joins of watch list, snapshots, captures, history and catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewatch.channels import batch_key, by_channel, channel_key, is_registered
from pricewatch.fixed_values import (
    CANARY_BAND,
    ELKJOP_BRANDS,
    FROM_API,
    FROM_BATCH,
    SEARCH_CANARY_RANGE,
    SERIES_KEY,
    STATUS_DEAD,
    STATUS_NAVIGATION,
    STATUS_NO_PRICE,
    STATUS_OK,
    STATUS_UNSUPPORTED,
    TARGET_YEARS,
    VARIANTS_PER_SEED,
)
from pricewatch.functions import attributes, classify, identity, price
from pricewatch.functions.once import computed_once
from pricewatch.functions.text import blank_to_null, or_empty, strip
from pricewatch.functions.trend import trend_code
from pricewatch.session import spread

BATCH_KEY = ["channel", "batch_key"]


def with_batch_key(links: DataFrame) -> DataFrame:
    """Add channel and batch key; links that carry them already stay as they are."""
    if set(BATCH_KEY) <= set(links.columns):
        return links
    platform = F.col("platform")
    return computed_once(
        links, {"channel": channel_key(platform), "batch_key": batch_key(platform, F.col("url"))}
    )


def batch_snapshot(items: DataFrame) -> DataFrame:
    """Priced catalogue items to one price per batch key; the last item of a key wins."""
    published = by_channel(F.col("platform"), lambda c: F.lit(c.batch_prices), F.lit(False))
    priced = with_batch_key(items.filter(published & F.col("price_local").isNotNull()))
    last = F.max(F.struct("pos", "price_local", "currency"))
    return (
        priced.filter(F.col("batch_key") != "")
        .groupBy(*BATCH_KEY)
        .agg(last.alias("__last"))
        .select(
            *BATCH_KEY,
            F.col("__last.price_local").alias("price"),
            F.col("__last.currency").alias("currency"),
        )
    )


def snapshot_match(links: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Every link with its batch price, status and provenance where the snapshot has one."""
    hit = F.col("price").isNotNull()
    return (
        with_batch_key(links)
        .join(snapshot, BATCH_KEY, "left")
        .withColumn("status", F.when(hit, STATUS_OK).otherwise("Pending"))
        .withColumn("provenance", F.when(hit, FROM_BATCH).otherwise(""))
    )


def page_outcomes(captures: DataFrame) -> DataFrame:
    """Latest capture of each address, for the page step of the cascade."""
    wanted = ("http_status", "final_url", "page_title", "page_price", "page_currency", "blocked")
    if "blocked" not in captures.columns:
        captures = captures.withColumn("blocked", F.lit(False))
    latest = F.max(F.struct("captured_at", *wanted)).alias("__c")
    return (
        captures.groupBy(F.col("requested_url").alias("url"))
        .agg(latest)
        .select("url", F.lit(True).alias("captured"), *(f"__c.{c}" for c in wanted))
    )


def newest_captures(captures: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of the wanted addresses (column ``url``), the captures of the newest time.

    The newest time is found on two light columns, so pages are neither parsed nor grouped
    before the choice; what stays is what the lookup of the latest capture can read.
    """
    light = captures.select(F.col("requested_url").alias("url"), "captured_at").join(wanted.select("url"), "url", "left_semi")
    newest = light.groupBy("url").agg(F.max("captured_at").alias("__newest"))
    same = (F.col("requested_url") == F.col("url")) & F.col("captured_at").eqNullSafe(F.col("__newest"))
    return captures.join(newest, same, "left_semi")


def offered(links: DataFrame, snapshot: DataFrame, api: DataFrame) -> DataFrame:
    """Links with what the batch snapshot and the API know of them."""
    batch = snapshot.select(
        *BATCH_KEY, F.col("price").alias("batch_price"), F.col("currency").alias("batch_currency")
    )
    # One row for each SKU, or a repeated capture would repeat the link: the latest one.
    order = [F.col("captured_at")] if "captured_at" in api.columns else []
    newest = F.max(F.struct(*order, "price", "currency"))
    direct = api.groupBy(F.col("sku").alias("api_sku")).agg(newest.alias("__a")).select(
        "api_sku", F.col("__a.price").alias("api_price"), F.col("__a.currency").alias("api_currency")
    )
    platform, url = F.col("platform"), F.col("url")
    # Links without an API keep a key of their own: null keys would all meet in one task.
    own_sku = F.coalesce(
        by_channel(
            platform, lambda c: identity.elkjop_sku(url) if c.api_prices else F.lit(None).cast("string")
        ),
        F.concat(F.lit("no api "), url),
    )
    return (
        with_batch_key(links)
        .withColumn("api_sku", own_sku)
        .join(batch, BATCH_KEY, "left")
        .join(direct, "api_sku", "left")
        .withColumn("__known", is_registered(platform))
    )


def unpriced(offers: DataFrame) -> DataFrame:
    """Addresses whose page has to be read: neither snapshot nor API has a price."""
    missing = F.col("__known") & F.col("batch_price").isNull() & F.col("api_price").isNull()
    return offers.where(missing).select("url").distinct()


def settled(offers: DataFrame, pages: DataFrame) -> DataFrame:
    """Price, status and provenance of each link: the snapshot, else the API, else its page."""
    platform, url = F.col("platform"), F.col("url")
    joined = offers.join(pages, "url", "left")
    gone = by_channel(
        platform, lambda c: c.gone(F.col("http_status"), url, F.col("final_url")), F.lit(False)
    )
    dead = by_channel(platform, lambda c: c.dead_title(F.col("page_title")), F.lit(False))
    only = by_channel(
        platform,
        lambda c: F.upper("page_currency") == c.currency if c.key in ("amazon", "elkjop") else F.lit(True),
        F.lit(False),
    )
    page_price = F.when(~gone & ~dead & ~F.col("blocked") & only, F.col("page_price"))
    batch_hit, api_hit = F.col("batch_price").isNotNull(), F.col("api_price").isNotNull()
    page_hit = F.col("__page_price").isNotNull()
    judged = joined.withColumns({"__gone": gone, "__dead": dead, "__page_price": page_price})
    status = (
        F.when(~F.col("__known"), STATUS_UNSUPPORTED)
        .when(batch_hit | api_hit, STATUS_OK)
        .when(F.col("captured").isNull(), STATUS_NAVIGATION)
        .when(F.col("__gone"), STATUS_DEAD)
        .when(F.col("blocked"), STATUS_NAVIGATION)
        .when(F.col("__dead"), STATUS_DEAD)
        .when(page_hit, STATUS_OK)
        .otherwise(STATUS_NO_PRICE)
    )
    provenance = (
        F.when(~F.col("__known"), "")
        .when(batch_hit, FROM_BATCH)
        .when(api_hit, FROM_API)
        .when(F.col("__gone"), F.concat(F.lit("HTTP "), "http_status", F.lit(" → "), "final_url"))
        .when(F.col("blocked"), "")
        .when(F.col("__dead") | page_hit, or_empty(F.col("page_title")))
        .otherwise("")
    )
    source = (
        F.when(~F.col("__known"), F.lit(None))
        .when(batch_hit, F.struct(F.col("batch_price").alias("p"), F.col("batch_currency").alias("c")))
        .when(api_hit, F.struct(F.col("api_price").alias("p"), F.col("api_currency").alias("c")))
        .when(page_hit, F.struct(F.col("__page_price").alias("p"), F.col("page_currency").alias("c")))
    )
    return judged.withColumn("__s", source).select(
        "brand",
        *SERIES_KEY,
        F.col("__s.p").alias("price"),
        F.col("__s.c").alias("currency"),
        provenance.alias("provenance"),
        status.alias("status"),
    )


def price_cascade(links: DataFrame, snapshot: DataFrame, api: DataFrame, pages: DataFrame) -> DataFrame:
    """Price each link from the batch snapshot, else the API, else its captured page."""
    return settled(offered(links, snapshot, api), pages)


def trend_join(observations: DataFrame, latest: DataFrame) -> DataFrame:
    """Classify each price against the latest one of its series."""
    return (
        observations.join(latest, list(SERIES_KEY), "left")
        .withColumn("trend", trend_code(F.col("price"), F.col("old_price")))
    )


def requested_keys(links: DataFrame) -> DataFrame:
    return with_batch_key(links).select(*BATCH_KEY).distinct()


def covered_keys(links: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Requested keys found in the snapshot."""
    return requested_keys(links).join(snapshot, BATCH_KEY, "left_semi")


def guard_rows(links: DataFrame, snapshot: DataFrame, latest: DataFrame) -> DataFrame:
    """New/old ratio of each link with both prices; duplicates count once each."""
    return (
        with_batch_key(links)
        .join(snapshot, BATCH_KEY)
        .join(latest.filter(F.col("old_price") > 0), list(SERIES_KEY))
        .withColumn("ratio", F.col("price") / F.col("old_price"))
    )


def unseen(candidates: DataFrame, held: DataFrame) -> DataFrame:
    return candidates.join(held, "asin", "left_anti")


def flag_seen(candidates: DataFrame, held: DataFrame) -> DataFrame:
    """A held row takes the variant hint of any later sighting."""
    hints = candidates.groupBy("asin").agg(F.bool_or("variant_hint").alias("__hint"))
    return (
        held.join(hints, "asin", "left")
        .withColumn("variant_hint", F.col("variant_hint") | F.coalesce("__hint", F.lit(False)))
        .drop("__hint")
    )


def family_columns(items: DataFrame) -> DataFrame:
    """Family key of an item: upper-cased brand, series and whole-inch size."""
    return computed_once(
        items,
        {
            "brand_key": F.upper(or_empty(F.col("brand_raw"))),
            "series": attributes.series_of(F.col("brand_raw"), F.col("raw_text")),
            "size": F.coalesce(F.col("size_hint_inch"), F.lit(0.0)).cast("int"),
        },
    )


FAMILY = ["brand_key", "series"]


def missing_sizes(history: DataFrame, today: DataFrame) -> DataFrame:
    """Earlier items of known series whose size is absent today; the first per ASIN."""
    present = today.filter(F.col("series") != "").select(*FAMILY, "size").distinct()
    gone = history.filter((F.col("series") != "") & (F.col("size") != 0) & (F.col("asin") != ""))
    missing = gone.join(present, [*FAMILY, "size"], "left_anti")
    carried = [c for c in missing.columns if c not in ("asin", "pos")]
    first = F.min(F.struct("pos", *carried)).alias("__row")
    return missing.groupBy("asin").agg(first).select("asin", "__row.*")


def variant_expand(seeds: DataFrame, held: DataFrame, details: DataFrame,
                   per_seed: int = VARIANTS_PER_SEED) -> DataFrame:
    """New sibling items: the first references of each seed, joined to captured details.

    Brand and size come from the detail title, else from the seed and the reference text.
    """
    refs = (
        seeds.select("seed_pos", F.col("brand_raw").alias("seed_brand"), F.posexplode("refs").alias("pos", "ref"))
        .filter(F.col("pos") < per_seed)
        .select(
            "seed_pos", "seed_brand", "pos",
            F.upper(strip(or_empty(F.col("ref.asin")))).alias("asin"),
            F.col("ref.text").alias("ref_text"),
        )
        .filter(F.col("asin") != "")
        .join(held, "asin", "left_anti")
    )
    # Generated, text rules read the joined titles only; filters on them would move to all details.
    found = spread(computed_once(refs.join(details, "asin"), {"title": strip(or_empty(F.col("title")))}))
    brand = F.coalesce(blank_to_null(attributes.brand_by_word(F.col("title"))), F.col("seed_brand"))
    size = F.coalesce(attributes.size_amazon(F.col("title")), attributes.size_amazon(F.col("ref_text")))
    read = {"brand_raw": brand, "size_hint_inch": size, "__other": classify.is_non_tv(F.col("title"))}
    valid = computed_once(found, read).filter(
        (F.col("title") != "") & (F.col("brand_raw") != "") & F.col("size_hint_inch").isNotNull() & ~F.col("__other")
    )
    first = F.min(F.struct("seed_pos", "pos", "brand_raw", "title", "size_hint_inch", "price_text"))
    return valid.groupBy("asin").agg(first.alias("__v")).select(
        "asin",
        F.col("__v.brand_raw").alias("brand_raw"),
        F.col("__v.title").alias("raw_text"),
        F.col("__v.size_hint_inch").alias("size_hint_inch"),
        F.col("__v.price_text").alias("price_text"),
    )


def fill_missing_price(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Cards of target brands and years without a price take the detail page's NOK price."""
    raw = F.concat_ws(" ", blank_to_null(F.col("title")), blank_to_null(F.col("text")))
    year = F.coalesce(F.nullif(F.col("filter_year"), F.lit(0)), attributes.year_in(raw))
    wanted = (attributes.brand_elkjop(raw) != "") & year.isin(*TARGET_YEARS)
    detail = details.filter(F.col("currency") == "NOK").select(
        "product_key", price.within(F.col("price"), 100, 500_000).alias("__detail")
    )
    own = price.with_price(cards, price.as_kroner(F.col("price_text")), "__own", "__unit")
    read = own.withColumn("price_local", price.within(F.col("__own"), 100, 500_000)).drop("__own", "__unit")
    return (
        computed_once(read, {"__wanted": wanted})
        .join(detail, "product_key", "left")
        .withColumn(
            "price_local",
            F.coalesce(F.col("price_local"), F.when(F.col("__wanted"), F.col("__detail"))),
        )
        .drop("__wanted", "__detail")
    )


def canary_band(observed: DataFrame, canaries: DataFrame, markets: DataFrame) -> DataFrame:
    """Per market: does any anchor show its currency and a price near the known one?

    Anchors and markets are fixed literal tables, so both may be broadcast.
    """
    low, high = CANARY_BAND
    anchors = canaries.join(markets.select("market", "expected_currency"), "market")
    in_band = (
        (F.col("currency") == F.col("expected_currency"))
        & F.col("price").between(low * F.col("known_price"), high * F.col("known_price"))
    )
    seen = observed.join(F.broadcast(anchors), ["market", "asin"]).groupBy("market").agg(
        F.count("*").alias("checked"),
        F.count_if(in_band).alias("in_band"),
    )
    return markets.select("market").join(seen, "market", "left").select(
        "market",
        F.coalesce("checked", F.lit(0)).alias("checked"),
        F.coalesce("in_band", F.lit(0)).alias("in_band"),
        (F.coalesce("in_band", F.lit(0)) > 0).alias("passed"),
    )


def search_currency_canary(cards: DataFrame, markets: DataFrame) -> DataFrame:
    """Per market: does any plain TV card show a plausible price in the market's currency?"""
    priced = price.with_market_price(
        cards.join(F.broadcast(markets), "market"), F.col("price_text"), F.col("expected_currency")
    )
    plausible = (
        ~F.col("sponsored")
        & ~classify.is_non_tv(strip(or_empty(F.col("title"))))
        & F.coalesce(F.col("price_local").between(*SEARCH_CANARY_RANGE), F.lit(False))
    )
    return priced.groupBy("market").agg(
        F.count("*").alias("cards"), F.bool_or(plausible).alias("passed")
    )


def coverage_grid(brands: DataFrame, years, catalogue: DataFrame) -> DataFrame:
    """Expected brand and year combinations the catalogue does not hold."""
    grid = brands.select("brand", F.explode(F.array(*map(F.lit, years))).alias("year"))
    held = catalogue.select("brand", "year").distinct()
    return grid.join(held, ["brand", "year"], "left_anti")


def market_enrich(rows: DataFrame, markets: DataFrame) -> DataFrame:
    """Price rows by their market's currency; an unknown market keeps a null price."""
    known = rows.join(F.broadcast(markets.select("market", "expected_currency")), "market", "left")
    return price.with_market_price(known, F.col("price_text"), F.col("expected_currency"))
