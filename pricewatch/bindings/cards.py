"""Search and listing cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.operators import cards, paging
from pricewatch.operators.dedup import last_seen
from pricewatch.operators.reconcile import price_coverage
from pricewatch.session import written

# Reasons by the role's own columns: the first valid card of an id holds it.
_REASONS = """
    own AS (
        SELECT *, product_key AS asin, CASE
            WHEN product_key = '' THEN 'blank'
            WHEN brand = 'NoName' THEN 'no_brand'
            WHEN p_size % 9 = 2 AND p_size NOT IN (17, 23) AND size_text = '' THEN 'no_size'
            WHEN p_size IN (17, 23) THEN 'non_tv' END AS own_reason
        FROM {cards}),
    firsts AS (
        SELECT asin, min((query_no, page, pos)) AS first_at FROM own
        WHERE NOT sponsored AND own_reason IS NULL GROUP BY asin),
    reasons AS (
        SELECT own.*, CASE WHEN sponsored THEN 'sponsored' WHEN (query_no, page, pos) > first_at THEN 'duplicate'
            ELSE own_reason END AS reason
        FROM own LEFT JOIN firsts USING (asin))"""


@query("card_filter", f"WITH {_REASONS} SELECT part_no, coalesce(reason, 'kept') AS reason FROM reasons")
def card_filter(r):
    return cards.card_reasons(r["cards"]).select(
        "part_no", F.coalesce("reason", F.lit("kept")).alias("reason")
    )


@query("filter_reasons", f"""
    WITH {_REASONS}
    SELECT query, page, count(*) AS cards, count(*) FILTER (reason IS NULL) AS kept,
           count(*) FILTER (reason = 'sponsored') AS sponsored, count(*) FILTER (reason = 'duplicate') AS duplicate,
           count(*) FILTER (reason = 'no_brand') AS no_brand, count(*) FILTER (reason = 'no_size') AS no_size,
           count(*) FILTER (reason = 'non_tv') AS non_tv
    FROM reasons GROUP BY query, page""")
def filter_reasons(r):
    return cards.filter_reasons(cards.card_reasons(r["cards"]))


def _numbered(r):
    """Line items as the links of a listing: part = product, order and line = position."""
    return r["lineitem"].selectExpr(
        "l_partkey AS product_key",
        "l_orderkey * 8 + l_linenumber AS pos",
        "concat('/products/', CAST(l_orderkey AS STRING)) AS href",
        "CASE WHEN l_quantity > 25 THEN '' ELSE concat('TV ', l_returnflag, repeat('x', CAST(l_quantity AS INT))) END AS title",
        "CASE WHEN l_discount > 0.05 THEN '' ELSE concat('£', CAST(l_orderkey AS STRING)) END AS price_text",
    )


@query("card_merge", """
    WITH links AS (
        SELECT l_partkey AS product_key, l_orderkey * 8 + l_linenumber AS pos, l_orderkey,
               CASE WHEN l_quantity > 25 THEN '' ELSE concat('TV ', l_returnflag, repeat('x', CAST(l_quantity AS INT))) END AS title,
               CASE WHEN l_discount > 0.05 THEN '' ELSE concat('£', CAST(l_orderkey AS STRING)) END AS price_text
        FROM lineitem)
    SELECT product_key, arg_max(title, (length(title), -pos, title)) AS title,
           coalesce(arg_min(price_text, pos) FILTER (price_text <> ''), '') AS price_text,
           arg_min(concat('/products/', CAST(l_orderkey AS STRING)), pos) AS href
    FROM links GROUP BY product_key""")
def card_merge(r):
    return cards.merge_links(_numbered(r), ["product_key"])


@query("card_merge_longest", """
    WITH cards AS (
        SELECT l_partkey AS product_key, l_orderkey * 8 + l_linenumber AS pos,
               repeat('x', CAST(l_quantity AS INT)) AS text,
               CASE WHEN l_discount > 0.05 THEN '' ELSE concat('£', CAST(l_orderkey AS STRING)) END AS price_text
        FROM lineitem),
    longest AS (
        SELECT product_key, min(pos) AS pos, arg_min(price_text, (pos, price_text)) AS own_price, any_value(text) AS text
        FROM cards JOIN (SELECT product_key, max(length(text)) AS n FROM cards GROUP BY product_key) USING (product_key)
        WHERE length(text) = n GROUP BY product_key)
    SELECT longest.product_key, longest.pos, length(longest.text) AS text_length,
           coalesce(nullif(any_value(own_price), ''), arg_min(c.price_text, (c.pos, c.price_text)), '') AS price_text
    FROM longest LEFT JOIN cards c
      ON c.product_key = longest.product_key AND c.pos > longest.pos AND c.price_text <> ''
    GROUP BY longest.product_key, longest.pos, length(longest.text)""")
def card_merge_longest(r):
    rows = r["lineitem"].selectExpr(
        "l_partkey AS product_key",
        "l_orderkey * 8 + l_linenumber AS pos",
        "concat('/p/', CAST(l_orderkey AS STRING)) AS href",
        "l_returnflag AS title",
        "repeat('x', CAST(l_quantity AS INT)) AS text",
        "CASE WHEN l_discount > 0.05 THEN '' ELSE concat('£', CAST(l_orderkey AS STRING)) END AS price_text",
    )
    return cards.merge_longest_card(rows, ["product_key"]).select(
        "product_key", "pos", F.length("text").cast("long").alias("text_length"), "price_text"
    )


@query("min_card_price", """
    SELECT l_partkey AS product_key, min(CASE WHEN l_quantity >= 2
        AND l_extendedprice BETWEEN 50 AND 50000 THEN l_extendedprice END) AS price_local
    FROM lineitem GROUP BY l_partkey""")
def min_card_price(r):
    """Amounts with a thousands dot read as small numbers and fall out of the range."""
    plain = F.expr("format_number(l_extendedprice, '0.00')")
    text = F.when(F.col("l_quantity") < 2, "9.999,00 €").otherwise(
        F.concat(F.translate(plain, ".", ","), F.lit(" €"))
    )
    links = r["lineitem"].select(F.col("l_partkey").alias("product_key"), text.alias("price_text"))
    return cards.lowest_price(links, "product_key")


@query("first_seen", """
    SELECT part_no FROM {cards} WHERE product_key <> ''
    QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY page, pos) = 1""")
def first_seen(r):
    return cards.first_valid_cards(r["cards"]).select("part_no")


@query("last_seen", """
    SELECT product_key, max((query_no, page, pos))[2] AS page, arg_max(part_no, (query_no, page, pos)) AS part_no
    FROM {cards} GROUP BY product_key""")
def last(r):
    rows = r["cards"].select("product_key", "query_no", "page", "pos", "part_no")
    return last_seen(rows, ["product_key"], ["query_no", "page", "pos"]).select(
        "product_key", "page", "part_no"
    )


@query("price_coverage", """
    SELECT brand_raw, count(*) FILTER (p_size % 6 <> 1) AS items, count(price_local) FILTER (p_size % 6 <> 1) AS priced,
           count(*) FILTER (p_size % 6 = 1) AS nameless
    FROM {items} GROUP BY brand_raw""")
def coverage(r):
    """Some items lack a text, as null or empty."""
    text = F.expr("CASE p_size % 12 WHEN 1 THEN '' WHEN 7 THEN CAST(NULL AS STRING) ELSE raw_text END")
    return price_coverage(r["items"].withColumn("raw_text", text), ["brand_raw"])


# --- paging ------------------------------------------------------------------------

_NOVELTY = r"""
    seen AS (
        SELECT regexp_extract(url, '//([^/]+)', 1) AS query, CAST(floor(page_id / 10) AS INT) + 1 AS page,
               regexp_extract(url, '/(\d+)', 1) AS product_key
        FROM pages),
    novelty AS (
        SELECT query, page, new_items, CAST(sum(new_items) OVER (PARTITION BY query ORDER BY page) AS BIGINT) AS total_items,
               row_number() OVER (PARTITION BY query ORDER BY page) AS page_no
        FROM (SELECT query, page, count(DISTINCT CASE WHEN page = first_page THEN product_key END) AS new_items
              FROM (SELECT *, min(page) OVER (PARTITION BY query, product_key) AS first_page FROM seen)
              GROUP BY query, page))"""


def _seen(r):
    """Captured addresses as a page log: host = query, number in the path = product."""
    return r["pages"].select(
        F.regexp_extract("url", "//([^/]+)", 1).alias("query"),
        (F.floor(F.col("page_id") / 10) + 1).cast("int").alias("page"),
        F.regexp_extract("url", r"/(\d+)", 1).alias("product_key"),
    )


def _novelty(r, seen=None):
    seen = written(_seen(r), "seen") if seen is None else seen
    return paging.page_novelty(seen, seen.select("query", "page").distinct())


@query("page_novelty", f"WITH {_NOVELTY} SELECT query, page, new_items, total_items FROM novelty")
def page_novelty(r):
    return _novelty(r)


@query("stop_page", f"""
    WITH {_NOVELTY},
    single AS (SELECT query, min(page) FILTER (new_items = 0 AND page > 1) AS stop_page FROM novelty GROUP BY query),
    pairs AS (SELECT *, lag(new_items) OVER (PARTITION BY query ORDER BY page) AS before FROM novelty),
    doubled AS (SELECT query, min(page) FILTER (new_items = 0 AND before = 0) AS double_stop FROM pairs GROUP BY query)
    SELECT query, stop_page, double_stop, count(*) FILTER (page <= stop_page OR stop_page IS NULL) AS cards_kept
    FROM seen JOIN single USING (query) JOIN doubled USING (query) GROUP BY ALL""")
def stop_page(r):
    seen = written(_seen(r), "seen")
    stops = written(paging.stop_pages(_novelty(r, seen)), "stops")
    kept = paging.before_stop(seen, stops.drop("double_stop")).groupBy("query").agg(F.count("*").alias("cards_kept"))
    return stops.join(kept, "query")


@query("stop_page_failures", f"""
    WITH {_NOVELTY},
    fetched AS (SELECT *, CASE WHEN page % 3 = 0 THEN 503 ELSE 200 END AS http_status FROM novelty),
    pairs AS (SELECT *, lag(http_status) OVER (PARTITION BY query ORDER BY page) AS before FROM fetched)
    SELECT query, min(page) FILTER ((http_status <> 200 AND before <> 200)
        OR (http_status = 200 AND new_items = 0 AND page > 1)) AS stop_page
    FROM pairs GROUP BY query""")
def stop_page_failures(r):
    status = F.when(F.col("page") % 3 == 0, 503).otherwise(200)
    return paging.stop_page_failures(_novelty(r).withColumn("http_status", status))


@query("limits", f"""
    WITH {_NOVELTY}
    SELECT query, page, new_items FROM novelty WHERE page_no <= 2""")
def limits(r):
    return paging.first_pages(_novelty(r), 2).select("query", "page", "new_items")
