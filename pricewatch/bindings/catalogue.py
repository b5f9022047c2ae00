"""Catalogue items, families and snapshots."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from pricewatch.bindings.cards import _REASONS as REASONS
from pricewatch.bindings.registry import query
from pricewatch.bindings.responses import bodies, responses
from pricewatch.bindings.titles import _LINK_KEY as LINK_KEY, _LINK_TEXT as LINK_TEXT
from pricewatch.fixed_values import CATALOG_COLUMNS, VARIANTS_PER_SEED
from pricewatch.operators import match, scope
from pricewatch.operators.reconcile import family_sizes as count_sizes
from pricewatch.plans import catalogue as plan
from pricewatch.session import new_table_path, spread
from pricewatch.sinks import write_catalog
from pricewatch.sources.catalogue import recent_snapshots as newest_rows

_DAY = "date_add(DATE '2026-08-01', CAST(part_no % 12 AS INT))"
_SNAPSHOT_ITEMS = f"CAST(CAST({_DAY} AS DATE) AS STRING) AS snapshot_date"


def items(r):
    return match.family_columns(r["items"])


def today(r):
    """Small sizes were seen today, large ones in earlier snapshots, those between in both."""
    return items(r).filter("p_size <= 25")


def history(r):
    return items(r).filter("p_size > 15")


@query("family_sizes", """
    SELECT upper(brand_raw) AS brand_key, expected_series AS series, count(DISTINCT inches) AS sizes
    FROM {items} WHERE expected_series <> '' GROUP BY ALL""")
def family_sizes(r):
    return count_sizes(items(r), match.FAMILY)


@query("missing_sizes", """
    SELECT asin, part_no, brand_raw, expected_series AS series, inches AS size
    FROM {items} AS h WHERE p_size > 15 AND expected_series <> '' AND NOT EXISTS (
        SELECT 1 FROM {items} AS t WHERE t.p_size <= 25 AND t.expected_series = h.expected_series
          AND upper(t.brand_raw) = upper(h.brand_raw) AND t.inches = h.inches AND t.p_type <> 'LARGE')""")
def missing_sizes(r):
    present = today(r).filter("p_type <> 'LARGE'")
    return match.missing_sizes(history(r), present).select("asin", "part_no", "brand_raw", "series", "size")


@query("already_seen", """
    SELECT asin, part_no FROM {items} WHERE p_size > 15
      AND asin NOT IN (SELECT asin FROM {items} WHERE p_size <= 25)""")
def already_seen(r):
    return match.unseen(history(r), today(r)).select("asin", "part_no")


@query("already_seen_hints", """
    SELECT held.asin, held.variant_hint OR coalesce(bool_or(c.p_size % 3 = 0), false) AS variant_hint
    FROM {items} AS held LEFT JOIN {items} AS c ON c.asin = held.asin AND c.p_size > 15
    WHERE held.p_size <= 25 GROUP BY held.asin, held.variant_hint""")
def already_seen_hints(r):
    candidates = history(r).withColumn("variant_hint", F.expr("p_size % 3 = 0"))
    return match.flag_seen(candidates, today(r)).select("asin", "variant_hint")


@query("coverage_grid", """
    WITH named AS (SELECT p_brand AS brand FROM {part} UNION SELECT concat('Range ', CAST(p_size AS STRING), ' ', p_brand) FROM {part}),
    grid AS (SELECT brand, year FROM named, (VALUES (2025), (2026)) AS y(year))
    SELECT brand, year FROM grid EXCEPT
    (SELECT p_brand, CASE WHEN p_size % 2 = 0 THEN 2025 ELSE 2026 END FROM {part}
     UNION ALL SELECT concat('Range ', CAST(p_size AS STRING), ' ', p_brand), CASE WHEN p_size % 2 = 0 THEN 2025 ELSE 2026 END FROM {part})""")
def coverage_grid(r):
    """Brands and their ranges by size; a range exists in one year only."""
    parts = r["part"].withColumn("p_brand", F.explode(F.array("p_brand", F.concat_ws(" ", F.lit("Range"), "p_size", "p_brand"))))
    brands = parts.select(F.col("p_brand").alias("brand")).distinct()
    held = parts.selectExpr(
        "p_brand AS brand", "CASE WHEN p_size % 2 = 0 THEN 2025 ELSE 2026 END AS year"
    )
    return match.coverage_grid(brands, (2025, 2026), held)


def _snapshots(r):
    """Items as dated snapshots: twelve days, products repeat every seven parts."""
    return r["items"].selectExpr(
        "*",
        "CASE WHEN p_size % 2 = 0 THEN 'DE' ELSE 'GB' END AS country",
        f"{_SNAPSHOT_ITEMS}",
    ).withColumn("asin", F.expr("concat('b', lpad(CAST(part_no - part_no % 7 AS STRING), 9, '0'))"))


@query("recent_snapshots", """
    WITH snaps AS (
        SELECT *, CASE WHEN p_size % 2 = 0 THEN 'DE' ELSE 'GB' END AS country, CAST(part_no % 12 AS INT) AS day_no,
               concat('B', lpad(CAST(part_no - part_no % 7 AS STRING), 9, '0')) AS id
        FROM {items}),
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY country ORDER BY day_no DESC) AS age FROM snaps)
    SELECT country, id AS asin, arg_max(part_no, (day_no, part_no)) AS part_no
    FROM ranked WHERE age <= 7 AND expected_series <> '' GROUP BY country, id""")
def recent_snapshots(r):
    return newest_rows(_snapshots(r)).select("country", "asin", "part_no")


@query("catalog_snapshot", """
    SELECT CASE WHEN p_size % 2 = 0 THEN 'DE' ELSE 'GB' END AS country, count(*) AS items,
           count(price_local) AS priced, count(DISTINCT part_no % 12) AS days
    FROM {items} GROUP BY country""")
def catalog_snapshot(r):
    """Write dated snapshots as partitions and read them back."""
    path = new_table_path(r.spark, "catalog")
    rows = _snapshots(r).selectExpr("*", "'Amazon' AS platform", "CAST(snapshot_date AS TIMESTAMP) AS scraped_at")
    write_catalog(rows, path)
    return r.spark.read.parquet(path).groupBy("country").agg(
        F.count("*").alias("items"),
        F.count("price_local").alias("priced"),
        F.count_distinct("snapshot_date").alias("days"),
    )


@query("facet_filter", """
    SELECT part_no, brand_raw AS brand FROM {items}
    WHERE p_size % 5 = 0 AND brand_raw <> 'Philips' AND p_type <> 'ECONOMY'""")
def facet_filter(r):
    products = r["items"].selectExpr(
        "part_no", "brand_raw AS brand",
        "CASE WHEN p_size % 5 = 0 THEN 2026 ELSE 2025 END AS facet_year",
        "CASE WHEN p_type = 'ECONOMY' THEN 'PT1' ELSE 'PT351' END AS taxonomy",
    )
    return scope.facet_filter(products, 2026).select("part_no", "brand")


@query("variant_expand", """
    WITH refs AS (
        SELECT o_custkey AS seed_pos, l_partkey,
               row_number() OVER (PARTITION BY o_custkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS ref_no
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey),
    valid AS (
        SELECT seed_pos, ref_no, asin, brand_raw, raw_text, size_hint_inch
        FROM refs JOIN {items} AS i ON i.part_no = refs.l_partkey
        WHERE ref_no <= 10 AND i.p_size > 25)
    SELECT asin, brand_raw, raw_text, size_hint_inch FROM valid GROUP BY ALL""")
def variant_expand(r):
    """Customers as seeds with the first things that they ordered as references."""
    lines = r["lineitem"].join(r["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    # Only the references that are looked at are gathered: the rank is a limit before the shuffle.
    turn = F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order))
    lines = lines.select("o_custkey", *order, turn.alias("turn")).filter(F.col("turn") <= VARIANTS_PER_SEED)
    seeds = lines.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("lines"))
    asin = "lower(concat('B', lpad(CAST(x.l_partkey AS STRING), 9, '0')))"
    seeds = seeds.select(
        F.col("o_custkey").alias("seed_pos"),
        F.lit("Seed").alias("brand_raw"),
        F.expr(f"transform(lines, x -> named_struct('asin', {asin}, 'text', '55 inch'))").alias("refs"),
    )
    details = r["items"].select("asin", F.col("raw_text").alias("title"), F.lit("£1").alias("price_text"))
    return match.variant_expand(seeds, today(r), details).select(
        "asin", "brand_raw", "raw_text", "size_hint_inch"
    )


@query("fill_missing_price", """
    SELECT part_no, CASE WHEN p_size % 7 <> 0 THEN floor(p_retailprice)
        WHEN brand_raw <> 'Philips' AND p_size % 3 <> 0 THEN floor(p_retailprice) + 500 END::DOUBLE AS price_local
    FROM {items}""")
def fill_missing_price(r):
    """Cards of sizes divisible by seven lack a price; detail pages of others than threes have one."""
    cards = r["items"].selectExpr(
        "part_no", "asin AS product_key", "raw_text AS title", "'' AS text", "2025 AS filter_year",
        "CASE WHEN p_size % 7 = 0 THEN '' ELSE concat(CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), '.-') END AS price_text",
    )
    details = r["items"].selectExpr(
        "asin AS product_key", "floor(p_retailprice) + 500.0D AS price",
        "CASE WHEN p_size % 3 = 0 THEN 'SEK' ELSE 'NOK' END AS currency",
    )
    return match.fill_missing_price(cards, details).select("part_no", "price_local")


# --- the catalogue job -------------------------------------------------------------

_SCRAPED = "TIMESTAMP '2026-08-03 05:00:00'"


def _job(r, key: str, rows):
    """Run the job for one catalogue and read its partition back with all columns."""
    path = new_table_path(r.spark, f"catalogue-{key}")
    outcome = plan.catalogue_job({key: rows}, F.expr(_SCRAPED), path)
    if outcome != {key: "written"}:
        raise RuntimeError(str(outcome))
    return r.spark.read.parquet(path).filter("snapshot_date = DATE '2026-08-03'").select(*CATALOG_COLUMNS)


@query("catalogue_boulanger", f"""
    WITH links AS (SELECT {LINK_KEY} AS link_key, part_no AS pos, line_no, p_retailprice, {LINK_TEXT} AS text FROM {{models}}),
    scored AS (
        SELECT link_key, pos, text,
               CASE line_no WHEN 0 THEN 130 WHEN 3 THEN 0 ELSE 30 END
               + CASE WHEN length(text) BETWEEN 25 AND 100 THEN 20 ELSE 0 END
               + CASE WHEN line_no = 3 AND position('tv' IN lower(substr(text, 1, 10))) > 0 THEN 30 ELSE 0 END AS score
        FROM links WHERE line_no IN (0, 3, 5)),
    named AS (SELECT link_key, text AS raw_text FROM scored
              QUALIFY row_number() OVER (PARTITION BY link_key ORDER BY score DESC, pos) = 1),
    lowest AS (SELECT link_key, min(floor(p_retailprice)) AS price_hint_eur FROM links GROUP BY link_key)
    SELECT raw_text, concat('https://www.boulanger.com/ref/', CAST(link_key AS STRING)) AS url, price_hint_eur,
           'Boulanger' AS platform, 'FR' AS country
    FROM named JOIN lowest USING (link_key)""")
def catalogue_boulanger(r):
    links = r["models"].selectExpr(
        f"concat('/ref/', CAST({LINK_KEY} AS STRING), '#avis') AS href", "part_no AS pos", f"{LINK_TEXT} AS text",
        "concat(CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), ',00 €') AS price_text",
    )
    return _job(r, "boulanger", lambda: plan.boulanger_rows(links)).select(
        "raw_text", "url", "price_hint_eur", "platform", "country"
    )


@query("catalogue_currys", """
    WITH links AS (
        SELECT l_partkey, l_orderkey * 8 + l_linenumber AS pos, l_orderkey, l_discount FROM lineitem)
    SELECT concat('samsung s90f ', CAST(40 + l_partkey % 50 AS STRING), ' qe', CAST(l_partkey AS STRING), 'x') AS raw_text,
           concat('https://www.currys.co.uk/products/', CAST(arg_min(l_orderkey, pos) AS STRING)) AS url,
           CASE WHEN arg_min(l_orderkey, pos) FILTER (l_discount <= 0.05) BETWEEN 50 AND 50000
                THEN arg_min(l_orderkey, pos) FILTER (l_discount <= 0.05) END::DOUBLE AS price_hint_eur,
           'Currys' AS platform, 'GB' AS country
    FROM links GROUP BY l_partkey""")
def catalogue_currys(r):
    """Line items as listing links; the slug names the product."""
    links = r["lineitem"].selectExpr(
        "concat('samsung-s90f-', CAST(40 + l_partkey % 50 AS STRING), '-qe', CAST(l_partkey AS STRING), 'x') AS product_key",
        "l_orderkey * 8 + l_linenumber AS pos",
        "concat('/products/', CAST(l_orderkey AS STRING)) AS href",
        "'TV' AS title",
        "CASE WHEN l_discount > 0.05 THEN '' ELSE concat('£', CAST(l_orderkey AS STRING)) END AS price_text",
    )
    return _job(r, "currys", lambda: plan.currys_rows(links)).select(
        "raw_text", "url", "price_hint_eur", "platform", "country"
    )


@query("catalogue_amazon", f"""
    WITH {REASONS}
    SELECT asin, brand_raw, concat('https://www.amazon.co.uk/dp/', asin) AS url, floor(p_retailprice) + 0.5 AS price_local,
           'GBP' AS currency, round((floor(p_retailprice) + 0.5) / 0.85973, 2) AS price_hint_eur, '2026-07-01' AS fx_rate_date
    FROM (SELECT part_no, asin, title_brand AS brand_raw FROM reasons WHERE reason IS NULL) JOIN {{part}} ON p_partkey = part_no""")
def catalogue_amazon(r):
    """Search cards of the British market, whose currency the cards confirm."""
    return _job(r, "amazon_gb", lambda: plan.amazon_rows(r["cards"], "GB")).select(
        "asin", "brand_raw", "url", "price_local", "currency", "price_hint_eur", "fx_rate_date"
    )


_SHELF = ("elkjop_sku", "brand_raw", "raw_text", "url", "size_hint_inch", "price_local", "price_hint_eur", "filter_year", "model_year",
          "source_brand", "platform", "country")


@query("catalogue_elkjop", """
    SELECT sku AS elkjop_sku, CASE brand WHEN 'Philips' THEN 'TCL' ELSE brand END AS brand_raw,
           concat(facet_brand, ' ', inches, '" TV MA', sku) AS raw_text, concat('https://www.elkjop.no/product/tv/', sku) AS url,
           CAST(inches AS DOUBLE) AS size_hint_inch, p_retailprice AS price_local, round(p_retailprice / 11.3125, 2) AS price_hint_eur,
           year AS filter_year, year AS model_year, CASE brand WHEN 'Philips' THEN 'iFFALCON' ELSE brand END AS source_brand,
           'Elkjop' AS platform, 'NO' AS country
    FROM {shelf}""")
def catalogue_elkjop(r):
    """The API route: every gate passes."""
    flat = r["shelf"].selectExpr(
        "part_no AS o_orderkey", "year", "page_index", "sku", "facet_brand AS brand", "year AS facet_year", "inches",
        "p_retailprice AS amount", "'nok' AS currency",
    )
    return _job(r, "elkjop", lambda: plan.elkjop_rows(bodies(flat, F.lit(False)))).select(*_SHELF)


@query("catalogue_elkjop_listing", """
    WITH priced AS (
        SELECT *, CASE WHEN p_size % 7 <> 0 THEN floor(p_retailprice)
                       WHEN p_size % 3 <> 0 THEN floor(p_retailprice) + 500 END::DOUBLE AS price FROM {shelf})
    SELECT sku AS elkjop_sku, brand AS brand_raw,
           concat(brand, ' ', inches, '" TV', CASE WHEN p_size % 5 = 0 THEN ' 2026' ELSE '' END, ' long text of ', sku) AS raw_text,
           concat('https://www.elkjop.no/product/tv/', sku) AS url, CAST(inches AS DOUBLE) AS size_hint_inch, price AS price_local,
           round(price / 11.3125, 2) AS price_hint_eur, year AS filter_year,
           CAST(CASE WHEN p_size % 5 = 0 THEN 2026 ELSE year END AS INT) AS model_year, brand AS source_brand,
           'Elkjop' AS platform, 'NO' AS country
    FROM priced WHERE brand <> 'Philips'""")
def catalogue_elkjop_listing(r):
    """The API capture breaks its gates, so the listing counts; each product has an image link and a text link."""
    shelf = r["shelf"]
    title = "concat(brand, ' ', CAST(inches AS STRING), '\" TV', CASE WHEN p_size % 5 = 0 THEN ' 2026' ELSE '' END)"
    links = "CASE k WHEN 0 THEN '' ELSE concat('long text of ', sku) END"
    price = "CASE WHEN p_size % 7 = 0 THEN '' ELSE concat(CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), '.-') END"
    cards = shelf.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).selectExpr(
        "year", "page_index + 1 AS page", "part_no * 2 + k AS pos", "sku AS product_key",
        "concat('/product/tv/', sku, '?q=', CAST(k AS STRING)) AS href", f"{title} AS title", f"{links} AS text", f"{price} AS price_text",
    )
    total = shelf.groupBy("year").agg(F.count("*").alias("total"))
    on_page = shelf.groupBy("year", F.col("page_index").alias("i")).agg(F.count("*").alias("n")).join(total, "year")
    ranges = on_page.selectExpr(
        "year", "i + 1 AS page", "concat(i * 48 + 1, '–', i * 48 + n, ' av ', total, ' produkter') AS range_text"
    )
    details = shelf.selectExpr(
        "sku AS product_key", "floor(p_retailprice) + 500.0D AS price", "CASE WHEN p_size % 3 = 0 THEN 'SEK' ELSE 'NOK' END AS currency"
    )
    listing = plan.Listing(cards, ranges, details)
    return _job(r, "elkjop", lambda: plan.elkjop_rows(responses(r), listing)).select(*_SHELF)


def _kept_sql(name: str, where: str) -> str:
    """The cards that an order of reading keeps, with their series."""
    return f"""
    {name}_own AS (
        SELECT c.*, i.expected_series AS series, CASE WHEN c.product_key = '' THEN 'blank' WHEN c.brand = 'NoName' THEN 'no_brand'
            WHEN c.p_size % 9 = 2 AND c.p_size NOT IN (17, 23) AND size_text = '' THEN 'no_size'
            WHEN c.p_size IN (17, 23) THEN 'non_tv' END AS own_reason
        FROM {{cards}} AS c JOIN {{items}} AS i ON i.part_no = c.part_no WHERE {where}),
    {name}_first AS (
        SELECT product_key, min((query_no, page, pos)) AS first_at FROM {name}_own
        WHERE NOT sponsored AND own_reason IS NULL GROUP BY product_key),
    {name} AS (
        SELECT o.product_key AS asin, title_brand AS brand, series, inches, p_size, p_retailprice, o.part_no
        FROM {name}_own AS o JOIN {name}_first AS f ON f.product_key = o.product_key AND (query_no, page, pos) = first_at
        JOIN {{part}} ON p_partkey = o.part_no WHERE NOT sponsored AND own_reason IS NULL)""".replace("p_size, p_retailprice", "o.p_size, p_retailprice")


@query("catalogue_amazon_follow_up", f"""
    WITH {_kept_sql("base", "c.p_size <= 20")},
    searched_families AS (SELECT DISTINCT brand, series FROM base WHERE series <> ''),
    {_kept_sql("searched", "c.p_size > 20 AND (c.title_brand, i.expected_series) IN (SELECT (brand, series) FROM searched_families)")},
    held AS (SELECT * FROM base UNION ALL SELECT * FROM searched WHERE asin NOT IN (SELECT asin FROM base)),
    earlier AS (
        SELECT concat('C', substr(asin, 2)) AS asin, brand_raw AS brand, expected_series AS series, p_size, p_retailprice,
               inches + CASE WHEN p_size % 4 = 0 THEN 2 ELSE 0 END AS inches FROM {{items}}),
    recovered AS (
        SELECT * FROM earlier AS e WHERE series <> '' AND p_size % 5 <> 1 AND NOT EXISTS (
            SELECT 1 FROM held AS t WHERE t.brand = e.brand AND t.series = e.series AND t.inches = e.inches)),
    siblings AS (SELECT concat('D', substr(asin, 2)) AS asin, brand, p_retailprice FROM recovered WHERE p_size % 3 = 0),
    found AS (
        SELECT asin, brand, p_retailprice FROM held UNION ALL SELECT asin, brand, p_retailprice FROM recovered
        UNION ALL SELECT asin, brand, p_retailprice FROM siblings)
    SELECT asin, brand AS brand_raw, concat('https://www.amazon.co.uk/dp/', asin) AS url, floor(p_retailprice) + 0.5 AS price_local,
           round((floor(p_retailprice) + 0.5) / 0.85973, 2) AS price_hint_eur
    FROM found""")
def catalogue_amazon_follow_up(r):
    """Search cards, then rescue searches, missing sizes of earlier catalogues and the siblings that detail pages name."""
    cards = r["cards"]
    series = r["items"].select("part_no", F.col("expected_series").alias("series"), "brand_raw")
    searches = cards.filter("p_size > 20").join(series, "part_no").withColumn("query", F.lower(F.concat_ws(" ", "brand_raw", "series")))
    size = "inches + CASE WHEN p_size % 4 = 0 THEN 2 ELSE 0 END"
    earlier = r["items"].withColumn("asin", F.expr("concat('C', substr(asin, 2))")).withColumn("size_hint_inch", F.expr(f"CAST({size} AS DOUBLE)"))
    price = "concat('£', CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), '.50') AS price_text"
    sibling = "concat('D', substr(asin, 2))"
    pages = r["items"].filter("p_size % 5 <> 1").selectExpr(
        "concat('C', substr(asin, 2)) AS asin", f"concat(brand_raw, ' TV ', CAST({size} AS STRING), '\" ', series_text, ' 2026') AS title", price,
        f"CASE WHEN p_size % 3 = 0 THEN array(named_struct('asin', {sibling}, 'text', '')) END AS refs",
    )
    more = r["items"].selectExpr(
        f"{sibling} AS asin", "concat(brand_raw, ' TV ', CAST(inches AS STRING), '\" ', series_text) AS title", price,
        "CAST(NULL AS array<struct<asin: string, text: string>>) AS refs",
    )
    found = plan.LookedUp(searches, pages.unionByName(more))
    all_of = plan.Budgets(*[2**31 - 1] * 4)  # the whole job, whatever the size of the tables
    rows = lambda: plan.amazon_rows(
        cards.filter("p_size <= 20"), "GB", found=found, history=match.family_columns(spread(earlier)), budgets=all_of
    )
    return _job(r, "amazon_gb", rows).select("asin", "brand_raw", "url", "price_local", "price_hint_eur")
