"""Price log, trends, price texts and currencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.bindings.registry import query
from pricewatch.functions import price as px
from pricewatch.functions.markup import with_structured_price
from pricewatch.functions.once import computed_once
from pricewatch.functions.trend import trend_label
from pricewatch.operators import match, reconcile, recovery
from pricewatch.operators.cards import card_prices
from pricewatch.operators.retention import trim_window
from pricewatch.sources.price_log import latest_prices, price_history, successful

RUN_START = "2024-01-21"
_TREND = """CASE WHEN old_price IS NULL THEN 'NEW' WHEN price < old_price THEN 'DOWN'
            WHEN price > old_price THEN 'UP' ELSE 'FLAT' END"""


@query("latest_price", """
    SELECT product_name, country, platform, arg_max(price, (obs_date, obs_time, seq)) AS old_price
    FROM {price_log} WHERE status = 'Success' GROUP BY ALL""")
def latest_price(r):
    return latest_prices(price_history(r["price_log"]))


@query("latest_price_bulk", """
    SELECT product_name, country, platform, arg_max(price, (obs_date, seq, price)) AS old_price
    FROM {unit_prices} WHERE status = 'Success' GROUP BY ALL""")
def latest_price_bulk(r):
    return latest_prices(price_history(r["unit_prices"]))


@query("price_history_union", """
    SELECT platform, obs_date, count(*) AS prices, count(DISTINCT product_name) AS products,
           max(price) AS highest
    FROM (SELECT platform, obs_date, product_name, price FROM {price_log} WHERE status = 'Success'
          UNION ALL
          SELECT platform, obs_date, product_name, price FROM {unit_prices} WHERE status = 'Success')
    GROUP BY ALL""")
def price_history_union(r):
    return price_history(r["price_log"], r["unit_prices"]).groupBy("platform", "obs_date").agg(
        F.count("*").alias("prices"),
        F.count_distinct("product_name").alias("products"),
        F.max("price").alias("highest"),
    )


@query("trend_join", f"""
    WITH latest AS (
        SELECT product_name, country, platform, arg_max(price, (obs_date, obs_time, seq)) AS old_price
        FROM {{price_log}} WHERE status = 'Success' AND obs_date < '{RUN_START}' GROUP BY ALL)
    SELECT seq, product_name, country, platform, price, old_price, {_TREND} AS trend
    FROM {{price_log}} LEFT JOIN latest USING (product_name, country, platform)
    WHERE status = 'Success' AND obs_date >= '{RUN_START}'""")
def trend_join(r):
    log = successful(r["price_log"])
    earlier, run = log.filter(F.col("obs_date") < RUN_START), log.filter(F.col("obs_date") >= RUN_START)
    return match.trend_join(run, latest_prices(earlier)).select(
        "seq", "product_name", "country", "platform", "price", "old_price", "trend"
    )


_BASELINE = """arg_max(price, (obs_date, seq)) OVER (
    PARTITION BY product_name, country, platform ORDER BY CAST(obs_date AS DATE)
    RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)"""


@query("recompute_trends", f"""
    WITH based AS (SELECT *, {_BASELINE} AS old_price FROM {{price_log}} WHERE status = 'Success')
    SELECT seq, old_price, {_TREND} AS trend,
           CASE {_TREND} WHEN 'NEW' THEN '新上线' WHEN 'DOWN' THEN '降价' WHEN 'UP' THEN '涨价'
                ELSE '持平' END AS label
    FROM based WHERE obs_date >= '2024-01-11'""")
def recompute_trends(r):
    log = r["price_log"]
    recovered = successful(log).filter(F.col("obs_date") >= "2024-01-11")
    return recovery.recompute_trends(recovered, existing=log).select(
        "seq", "old_price", "trend", trend_label(F.col("trend")).alias("label")
    )


@query("recompute_trends_bulk", """
    WITH based AS (
        SELECT platform, price, max(CAST(obs_date AS DATE)) OVER earlier AS old_day,
               arg_max(price, (obs_date, seq, price)) OVER earlier AS old_price
        FROM {unit_prices} WHERE status = 'Success'
        WINDOW earlier AS (PARTITION BY product_name, country, platform ORDER BY CAST(obs_date AS DATE)
            RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT platform, count(*) FILTER (old_price IS NULL) AS new_rows,
           count(*) FILTER (price < old_price) AS down_rows,
           count(*) FILTER (price > old_price) AS up_rows,
           count(*) FILTER (price = old_price) AS flat_rows
    FROM based GROUP BY platform""")
def recompute_trends_bulk(r):
    rows = recovery.recompute_trends(successful(r["unit_prices"]))
    counts = [
        F.count_if(F.col("trend") == code).alias(f"{code.lower()}_rows")
        for code in ("NEW", "DOWN", "UP", "FLAT")
    ]
    return rows.groupBy("platform").agg(*counts)


@query("run_summary", """
    SELECT platform, count(*) AS total, count(*) FILTER (status = 'Success') AS ok,
           count(*) FILTER (status <> 'Success') AS failed,
           count(*) FILTER (provenance = 'Batch category snapshot') AS batch_hits
    FROM {price_log} GROUP BY platform""")
def run_summary(r):
    return reconcile.run_summary(r["price_log"])


@query("failed_platforms", """
    SELECT DISTINCT platform FROM {links}
    WHERE platform NOT IN (SELECT platform FROM {price_log})""")
def failed_platforms(r):
    return reconcile.failed_platforms(r["links"].select("platform").distinct(), r["price_log"])


@query("trim_window", """
    SELECT obs_date, count(*) AS kept FROM {price_log}
    WHERE CAST(obs_date AS DATE) >= (SELECT max(CAST(obs_date AS DATE)) - 14 FROM {price_log})
    GROUP BY obs_date""")
def trim(r):
    return trim_window(r["price_log"], 14).groupBy("obs_date").agg(F.count("*").alias("kept"))


@query("trim_window_bulk", """
    SELECT obs_date, count(*) AS kept FROM {unit_prices}
    WHERE CAST(obs_date AS DATE) >= (SELECT max(CAST(obs_date AS DATE)) - 45 FROM {unit_prices})
    GROUP BY obs_date""")
def trim_bulk(r):
    return trim_window(r["unit_prices"]).groupBy("obs_date").agg(F.count("*").alias("kept"))


@query("union_results", """
    SELECT platform, status, count(*) AS results
    FROM (SELECT platform, status FROM {price_log} UNION ALL SELECT platform, status FROM {unit_prices})
    GROUP BY ALL""")
def union_results(r):
    columns = ["product_name", "country", "platform", "price", "status"]
    both = r["price_log"].select(columns).unionByName(r["unit_prices"].select(columns))
    return both.groupBy("platform", "status").agg(F.count("*").alias("results"))


# --- price texts -------------------------------------------------------------------


@query("normalize_price_text", "SELECT part_no, price, currency FROM {price_texts}")
def normalize_price_text(r):
    texts = r["price_texts"].select("part_no", "price_text")
    return px.with_price(texts, F.col("price_text")).select("part_no", "price", "currency")


_SCHEMA_TEXT = """CASE part_no % 4 WHEN 0 THEN concat(CAST(cents AS STRING), 'e-2')
    WHEN 1 THEN concat(' ', CAST(CAST(floor(cents / 1000) AS BIGINT) AS STRING), ',', '499')
    WHEN 2 THEN 'n/a' ELSE concat(CAST(cents % 20 AS STRING), '.5') END"""


@query("normalize_schema_price", """
    SELECT part_no, CASE part_no % 4 WHEN 0 THEN cents / 100
        WHEN 1 THEN CAST(floor(cents / 1000) AS DOUBLE) * 1000 + 499 WHEN 2 THEN NULL
        ELSE CASE WHEN cents % 20 >= 10 THEN cents % 20 + 0.5 END END::DOUBLE AS price
    FROM {cents}""")
def normalize_schema_price(r):
    texts = r["cents"].selectExpr("part_no", f"{_SCHEMA_TEXT} AS amount_text")
    return px.with_schema_amount(texts, F.col("amount_text"), F.lit("gbp")).select("part_no", "price")


_CARD_TEXT = """CASE platform WHEN 'Boulanger' THEN concat(thousands, CASE WHEN thousands = '' THEN '' ELSE ' ' END, hundreds, ',', fraction, ' €')
    WHEN 'Currys' THEN concat('£', thousands, CASE WHEN thousands = '' THEN '' ELSE ',' END, hundreds, '.', fraction)
    WHEN 'Elkjop' THEN concat(thousands, ' ', hundreds, '.-')
    ELSE concat(thousands, CASE WHEN thousands = '' THEN '' ELSE '.' END, hundreds, ',', fraction, ' EUR') END"""
_CARD_PLATFORM = "CASE part_no % 4 WHEN 0 THEN 'Boulanger' WHEN 1 THEN 'Currys' WHEN 2 THEN 'Elkjop' ELSE 'Amazon' END"


@query("channel_card_price", f"""
    SELECT part_no, platform, CASE platform WHEN 'Elkjop' THEN CAST(whole AS DOUBLE) ELSE amount END AS price
    FROM (SELECT *, {_CARD_PLATFORM} AS platform FROM {{amounts}})""")
def channel_card_price(r):
    cards = r["amounts"].selectExpr("*", f"{_CARD_PLATFORM} AS platform").selectExpr(
        "part_no", "platform", f"{_CARD_TEXT} AS price_text"
    )
    return card_prices(cards).select("part_no", "platform", F.col("price_local").alias("price"))


@query("market_price_pair", """
    SELECT part_no, CASE WHEN currency = 'GBP' THEN price END AS price_local, currency,
           CASE WHEN currency = 'GBP' THEN round(price / 0.85973, 2) END AS price_eur
    FROM {price_texts}""")
def market_price_pair(r):
    texts = r["price_texts"].select("part_no", "price_text")
    return px.with_market_price(texts, F.col("price_text"), F.lit("GBP")).drop("price_text")


@query("price_range", """
    SELECT part_no, CASE WHEN price BETWEEN 950 AND 1000 THEN price END AS price FROM {price_texts}""")
def price_range(r):
    read = px.with_price(r["price_texts"].select("part_no", "price_text"), F.col("price_text"))
    return read.select("part_no", px.within(F.col("price"), 950, 1000).alias("price"))


_CURRENCY = "CASE c_nationkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN ' nok' WHEN 2 THEN 'GBP' ELSE 'USD' END"


@query("fx_to_eur", f"""
    SELECT c_custkey, {_CURRENCY} AS currency,
           CASE c_nationkey % 4 WHEN 0 THEN c_acctbal WHEN 1 THEN round(c_acctbal / 11.3125, 2)
                WHEN 2 THEN round(c_acctbal / 0.85973, 2) END AS price_eur
    FROM {{customer}}""")
def fx_to_eur(r):
    balances = r["customer"].selectExpr("c_custkey", "c_acctbal", f"{_CURRENCY} AS currency")
    return balances.select(
        "c_custkey", "currency", px.to_eur(F.col("c_acctbal"), F.col("currency")).alias("price_eur")
    )


@query("fx_rate_join", f"""
    SELECT currency, count(*) AS balances, count(price_eur) AS converted, round(sum(price_eur), 2) AS total_eur
    FROM (SELECT {_CURRENCY} AS currency,
                 CASE c_nationkey % 4 WHEN 0 THEN c_acctbal WHEN 1 THEN round(c_acctbal / 11.3125, 2)
                      WHEN 2 THEN round(c_acctbal / 0.85973, 2) END AS price_eur
          FROM {{customer}}) GROUP BY currency""")
def fx_rate_join(r):
    balances = r["customer"].selectExpr("c_acctbal", f"{_CURRENCY} AS currency")
    rates = schemas.fx_rates(r.spark).withColumnRenamed("currency", "code")
    eur = px.eur_at_rate(F.col("c_acctbal"), F.col("units_per_eur"))
    joined = balances.join(F.broadcast(rates), F.upper(F.trim("currency")) == F.col("code"), "left")
    return joined.withColumn("price_eur", eur).groupBy("currency").agg(
        F.count("*").alias("balances"),
        F.count("price_eur").alias("converted"),
        F.round(F.sum("price_eur"), 2).alias("total_eur"),
    )


@query("structured_page_price", """
    SELECT page_id,
           CASE WHEN page_id % 10 IN (5, 6) THEN NULL ELSE page_id + 20.5 END::DOUBLE AS price,
           CASE WHEN page_id % 10 IN (5, 6) THEN NULL WHEN page_id % 10 IN (0, 3) THEN 'GBP'
                WHEN page_id % 10 = 4 THEN 'NOK' ELSE 'EUR' END AS currency
    FROM {pages}""")
def structured_page_price(r):
    """Whole captured pages with the markup of ten page styles in front."""
    n, style = F.concat((F.col("page_id") + 20).cast("string"), F.lit(".5")), F.col("page_id") % 10
    ld = '<script type="application/ld+json">%s</script>'

    def markup(template: str):
        before, after = template.split("#")
        return F.concat(F.lit(before), n, F.lit(after))

    prefix = (
        F.when(style == 0, markup(
            '<meta property="product:price:amount" content="#"><meta property="product:price:currency" content="GBP">'))
        .when(style == 1, markup("<meta content='#' itemprop='price'>"))
        .when(style == 2, markup(ld % '{"@type":"Product","offers":{"price":"#"}}'))
        .when(style == 3, markup(
            ld % "not json" + ld % '[{"name":"x"},{"offers":[{"price":"5"},{"price":#,"priceCurrency":"GBP"}]}]'))
        .when(style == 4, markup(ld % '{"@graph":[{"@id":1},{"offers":{"price":#,"priceCurrency":"NOK"}}]}'))
        .when(style == 5, F.lit('<meta itemprop="price" content="7.99">'))
        .when(style == 7, markup('<!-- <meta itemprop="price" content="999"> --><meta itemprop=price content=#>'))
        .when(style == 8, markup('<meta itemprop="price" content="&nbsp;#"><meta itemprop="priceCurrency" content=EUR />'))
        .when(style == 9, markup(
            "<script>var tag = '<meta itemprop=\"price\" content=\"999\">';</script><meta data-itemprop='price' content=5>"
            "<meta content=\"#\" itemprop='price'>"))
        .otherwise(F.lit(""))
    )
    marked = computed_once(r["pages"].select("page_id", "html"), {"html": F.concat(prefix, F.col("html"))})
    return with_structured_price(marked, F.col("html")).select("page_id", "price", "currency")
