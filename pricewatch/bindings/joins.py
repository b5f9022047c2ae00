"""Watch list against snapshot, captures, history and markets."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.bindings.registry import query
from pricewatch.bindings.watch_list import active
from pricewatch.fixed_values import CANARIES
from pricewatch.operators import match
from pricewatch.sources.price_log import latest_prices, price_history

# Last offer per part on the channels that publish batch prices.
SNAPSHOT_SQL = """
    snapshot AS (
        SELECT part_no, arg_max(price_local, (pos, price_local)) AS price, lower(any_value(platform)) AS channel
        FROM {offers} WHERE platform IN ('Boulanger', 'Currys') GROUP BY part_no),
    requested AS (
        SELECT e.*, s.price AS batch_price FROM {expected_links} AS e
        LEFT JOIN snapshot AS s ON s.part_no = e.part_no AND s.channel = e.channel)"""
LATEST_SQL = """
    latest AS (
        SELECT part_no, product_name, country, platform, arg_max(price, (obs_date, seq, price)) AS old_price
        FROM {unit_prices} WHERE status = 'Success' GROUP BY ALL)"""


def snapshot(r):
    return match.batch_snapshot(r["offers"])


def latest(r):
    return latest_prices(price_history(r["unit_prices"]))


@query("batch_snapshot", f"""
    WITH {SNAPSHOT_SQL}
    SELECT channel, CAST(CASE channel WHEN 'boulanger' THEN 1000000 ELSE 10000000 END + part_no AS STRING) AS batch_key, price
    FROM snapshot""")
def batch_snapshot(r):
    return snapshot(r).select("channel", "batch_key", "price")


@query("snapshot_match", f"""
    WITH {SNAPSHOT_SQL}
    SELECT product_name, platform, batch_price AS price,
           CASE WHEN batch_price IS NULL THEN 'Pending' ELSE 'Success' END AS status,
           CASE WHEN batch_price IS NULL THEN '' ELSE 'Batch category snapshot' END AS provenance
    FROM requested""")
def snapshot_match(r):
    return match.snapshot_match(active(r), snapshot(r)).select(
        "product_name", "platform", "price", "status", "provenance"
    )


@query("coverage_join", f"""
    WITH {SNAPSHOT_SQL}
    SELECT DISTINCT channel, batch_key FROM requested WHERE batch_price IS NOT NULL""")
def coverage_join(r):
    return match.covered_keys(active(r), snapshot(r))


@query("guard_join", f"""
    WITH {SNAPSHOT_SQL}, {LATEST_SQL}
    SELECT r.product_name, r.platform, batch_price AS price, old_price, batch_price / old_price AS ratio
    FROM requested AS r JOIN latest USING (part_no) WHERE batch_price IS NOT NULL AND old_price > 0
      AND latest.platform = r.platform""")
def guard_join(r):
    return match.guard_rows(active(r), snapshot(r), latest(r)).select(
        "product_name", "platform", "price", "old_price", "ratio"
    )


def _api(r):
    """Direct prices for the larger Elkjop parts, captured twice; the first capture was half as high."""
    parts = r["part"].filter("p_size > 25").withColumn("captured_at", F.explode(F.array(F.lit(1), F.lit(2))))
    return parts.selectExpr(
        "CAST(100000 + p_partkey AS STRING) AS sku", "p_retailprice * 5 * captured_at AS price", "'NOK' AS currency", "captured_at"
    )


def _page_captures(r):
    """Captured product pages; the smallest products were never captured."""
    return r["links"].join(
        r["part"].selectExpr("p_partkey AS part_no", "p_size", "p_retailprice"), "part_no"
    ).filter("p_size > 10").selectExpr(
        "trim(url) AS requested_url",
        "CASE WHEN p_size % 5 = 2 THEN 'https://www.currys.co.uk/tvs' ELSE trim(url) END AS final_url",
        "CASE WHEN p_size = 30 THEN 404 ELSE 200 END AS http_status",
        "CASE WHEN p_size % 5 = 3 THEN 'Oups' ELSE 'A fine TV' END AS page_title",
        "p_retailprice + 1000 AS page_price",
        "CASE WHEN p_size % 3 = 0 THEN 'NOK' WHEN p_size % 3 = 1 THEN 'EUR' ELSE 'GBP' END AS page_currency",
        "p_size AS captured_at",
        "p_size % 11 = 6 AS blocked",
    )


def _pages(r):
    return match.page_outcomes(_page_captures(r))


_CASCADE = f"""
    WITH {SNAPSHOT_SQL},
    facts AS (
        SELECT r.*, p_size, p_retailprice,
               CASE WHEN channel = 'elkjop' AND p_size > 25 THEN p_retailprice * 10 END AS api_price,
               p_size <= 10 AS uncaptured,
               p_size = 30 OR (channel = 'currys' AND p_size % 5 = 2) AS gone,
               p_size % 11 = 6 AS blocked, channel = 'boulanger' AND p_size % 5 = 3 AS dead,
               CASE WHEN p_size % 3 = 0 THEN 'NOK' WHEN p_size % 3 = 1 THEN 'EUR' ELSE 'GBP' END AS page_currency
        FROM requested AS r JOIN {{part}} ON p_partkey = part_no),
    stepped AS (
        SELECT *, CASE WHEN platform = 'Corner Shop' THEN 'unsupported' WHEN batch_price IS NOT NULL THEN 'batch'
            WHEN api_price IS NOT NULL THEN 'api' WHEN uncaptured THEN 'navigation' WHEN gone THEN 'gone'
            WHEN blocked THEN 'navigation' WHEN dead THEN 'dead' WHEN channel = 'amazon' AND page_currency <> 'EUR' THEN 'none'
            WHEN channel = 'elkjop' AND page_currency <> 'NOK' THEN 'none' ELSE 'page' END AS step
        FROM facts)
    SELECT product_name, platform,
           CASE step WHEN 'batch' THEN batch_price WHEN 'api' THEN api_price WHEN 'page' THEN p_retailprice + 1000 END AS price,
           CASE step WHEN 'batch' THEN 'Batch category snapshot' WHEN 'api' THEN 'Direct API'
                WHEN 'gone' THEN concat('HTTP ', CASE WHEN p_size = 30 THEN 404 ELSE 200 END, ' → ',
                     CASE WHEN p_size % 5 = 2 THEN 'https://www.currys.co.uk/tvs' ELSE url END)
                WHEN 'dead' THEN 'Oups' WHEN 'page' THEN CASE WHEN p_size % 5 = 3 THEN 'Oups' ELSE 'A fine TV' END
                ELSE '' END AS provenance,
           CASE step WHEN 'unsupported' THEN 'Skipped: Unsupported Platform' WHEN 'navigation' THEN 'Failed: Navigation Error'
                WHEN 'gone' THEN 'Failed: Dead Link' WHEN 'dead' THEN 'Failed: Dead Link'
                WHEN 'none' THEN 'Failed: Price Not Found' ELSE 'Success' END AS status
    FROM stepped"""


@query("price_cascade", _CASCADE)
def price_cascade(r):
    return match.price_cascade(active(r), snapshot(r), _api(r), _pages(r)).select(
        "product_name", "platform", "price", "provenance", "status"
    )


# --- markets and canaries ----------------------------------------------------------

_MARKET = "CASE c_nationkey % 5 WHEN 0 THEN 'DE' WHEN 1 THEN 'GB' WHEN 2 THEN 'IT' WHEN 3 THEN 'ES' ELSE 'PL' END"


@query("market_enrich", f"""
    WITH rows AS (SELECT c_custkey, {_MARKET} AS market, round(abs(c_acctbal), 2) AS amount, c_mktsegment FROM {{customer}}),
    known AS (SELECT *, CASE market WHEN 'GB' THEN 'GBP' WHEN 'PL' THEN NULL ELSE 'EUR' END AS expected_currency,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'GBP' ELSE 'EUR' END AS currency FROM rows)
    SELECT c_custkey, market, expected_currency, currency,
           CASE WHEN currency = expected_currency THEN amount END AS price_local,
           CASE WHEN currency = expected_currency THEN
                CASE WHEN currency = 'GBP' THEN round(amount / 0.85973, 2) ELSE amount END END AS price_eur
    FROM known""")
def market_enrich(r):
    rows = r["customer"].selectExpr(
        "c_custkey", f"{_MARKET} AS market",
        "concat(CASE WHEN c_mktsegment = 'BUILDING' THEN '£' ELSE '' END, "
        "CAST(CAST(abs(c_acctbal) AS DECIMAL(12, 2)) AS STRING)) AS price_text",
    )
    return match.market_enrich(rows, schemas.markets(r.spark)).drop("price_text")


@query("canary_band", """
    WITH anchors(market, n, known, currency) AS (VALUES ('DE', 0, 229.99, 'EUR'), ('DE', 1, 169.99, 'EUR'),
        ('GB', 0, 149.0, 'GBP'), ('GB', 1, 138.0, 'GBP'), ('IT', 0, 159.0, 'EUR'), ('IT', 1, 159.0, 'EUR'),
        ('ES', 0, 154.9, 'EUR'), ('ES', 1, 149.0, 'EUR')),
    observed AS (
        SELECT CASE user_id % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'GB' WHEN 2 THEN 'IT' ELSE 'ES' END AS market,
               event_id % 2 AS n, value, CASE event_type WHEN 'view' THEN 'GBP' ELSE 'EUR' END AS currency
        FROM {events})
    SELECT a.market, count(*) AS checked,
           count(*) FILTER (o.currency = a.currency AND o.value BETWEEN 0.5 * known AND 1.5 * known) AS in_band,
           count(*) FILTER (o.currency = a.currency AND o.value BETWEEN 0.5 * known AND 1.5 * known) > 0 AS passed
    FROM anchors AS a JOIN observed AS o ON o.market = a.market AND o.n = a.n GROUP BY a.market""")
def canary_band(r):
    """Events as looked-up anchor prices: user = market, event number = which anchor."""
    seen = r["events"].selectExpr(
        "CASE user_id % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'GB' WHEN 2 THEN 'IT' ELSE 'ES' END AS market",
        "event_id % 2 AS n", "value AS price",
        "CASE event_type WHEN 'view' THEN 'GBP' ELSE 'EUR' END AS currency",
    )
    ids = {m: [a for mk, a, _ in CANARIES if mk == m] for m in ("DE", "GB", "IT", "ES")}
    asin = F.coalesce(*(
        F.when((F.col("market") == m) & (F.col("n") == n), a) for m, pair in ids.items() for n, a in enumerate(pair)
    ))
    return match.canary_band(seen.withColumn("asin", asin), schemas.canaries(r.spark), schemas.markets(r.spark))


@query("search_currency_canary", """
    SELECT CASE WHEN p_size % 2 = 0 THEN 'GB' ELSE 'DE' END AS market, count(*) AS cards,
           bool_or(p_size % 2 = 0 AND NOT sponsored AND p_size NOT IN (17, 23)) AS passed
    FROM {cards} GROUP BY ALL""")
def search_currency_canary(r):
    """Every card shows pounds, so only the British market can pass."""
    cards = r["cards"].withColumn("market", F.expr("CASE WHEN p_size % 2 = 0 THEN 'GB' ELSE 'DE' END"))
    return match.search_currency_canary(cards, schemas.markets(r.spark))
