"""Captured API responses and their completeness checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.operators import reconcile
from pricewatch.sources import api


def responses(r):
    """Orders as search responses; one page of 2025 states another total than the rest."""
    return bodies(r["flat_hits"], F.expr("year = 2025 AND page_index = 5"))


def bodies(flat, drifting):
    """Flat hits as search responses: one JSON body per year and page; drifting pages state one hit more."""
    size = F.when(F.col("brand") == "LG", F.lit("n/a")).otherwise(F.col("inches").cast("string"))
    url = F.when((F.col("brand") == "LG") & (F.col("inches") > 100), F.lit("/product/tv/other")).otherwise(
        F.concat(F.lit("/product/tv/"), F.col("sku"), F.lit("?q=1"))
    )
    title = F.concat(F.trim("brand"), F.lit(" "), F.col("inches").cast("string"), F.lit('" TV'))
    hit = F.struct(
        F.when(F.col("brand") != "TCL", F.col("sku")).alias("articleNumber"),
        F.col("sku").alias("objectID"),
        F.col("brand").alias("brand"),
        title.alias("title"),
        title.alias("name"),
        F.concat(F.lit("MA"), F.col("sku")).alias("manufacturerArticleNumber"),
        url.alias("productUrl"),
        F.struct(F.col("amount").alias("amount"), F.col("currency").alias("currency")).alias("price"),
        F.create_map(
            F.lit("33627"), F.array(F.col("facet_year").cast("string")), F.lit("31323"), F.array(size)
        ).alias("attributes"),
        F.lit(" ").alias("shortDescription"),
    )
    pages = flat.groupBy("year", "page_index").agg(
        F.array_sort(
            F.collect_list(F.struct("o_orderkey", hit.alias("hit"))),
            lambda a, b: F.when(a["o_orderkey"] < b["o_orderkey"], -1).otherwise(1),
        ).alias("rows")
    )
    totals = flat.groupBy("year").agg(
        F.count("*").cast("int").alias("n"), (F.max("page_index") + 1).cast("int").alias("p")
    )
    stated = F.when(drifting, F.col("n") + 1).otherwise(F.col("n"))
    body = F.to_json(
        F.struct(
            F.array(
                F.struct(stated.alias("nbHits"), F.col("p").alias("nbPages"), F.col("rows.hit").alias("hits"))
            ).alias("results")
        )
    )
    # One row per year; a shuffle by year would bring all pages of a year to one task.
    return pages.join(F.broadcast(totals), "year").select("year", "page_index", body.alias("body"))


def hits(r):
    return api.api_hits(responses(r))


_FLAT = """
    hits AS (
        SELECT year, page_index, row_number() OVER (PARTITION BY year, page_index ORDER BY o_orderkey) - 1 AS pos, sku,
               CASE lower(trim(brand)) WHEN 'hisense' THEN 'Hisense' WHEN 'lg' THEN 'LG' WHEN 'iffalcon' THEN 'iFFALCON'
                    WHEN 'samsung' THEN 'Samsung' WHEN 'sony' THEN 'Sony' WHEN 'tcl' THEN 'TCL' END AS source_brand,
               facet_year, CASE WHEN inches BETWEEN 24 AND 120 THEN inches END::DOUBLE AS size_hint_inch,
               CASE WHEN brand = 'LG' AND inches > 100 THEN 'https://www.elkjop.no/product/tv/other'
                    ELSE concat('https://www.elkjop.no/product/tv/', sku) END AS url,
               concat(trim(brand), ' ', inches, '" TV MA', sku) AS raw_text, amount, upper(currency) AS currency, brand
        FROM {flat_hits}),
    pages AS (
        SELECT year, page_index, any_value(total) + CASE WHEN year = 2025 AND page_index = 5 THEN 1 ELSE 0 END AS nb_hits,
               any_value(pages) AS nb_pages, count(*) AS page_hits
        FROM (SELECT *, count(*) OVER (PARTITION BY year) AS total, max(page_index) OVER (PARTITION BY year) + 1 AS pages FROM hits)
        GROUP BY year, page_index)"""


@query("api_hits", f"""
    WITH {_FLAT}
    SELECT year, page_index, CAST(pos AS INT) AS pos, sku, source_brand, facet_year, size_hint_inch, url, raw_text, amount, currency
    FROM hits""")
def api_hits(r):
    return hits(r).drop("brand")


@query("api_pages", f"""
    WITH {_FLAT}
    SELECT year, page_index, CAST(nb_hits AS INT) AS nb_hits, CAST(nb_pages AS INT) AS nb_pages,
           CAST(page_hits AS INT) AS page_hits FROM pages""")
def api_pages(r):
    return api.api_pages(responses(r))


@query("api_items", f"""
    WITH {_FLAT}
    SELECT sku AS elkjop_sku, count(*) AS items, count(CASE WHEN currency = 'NOK' AND amount BETWEEN 100 AND 500000 THEN 1 END) AS priced,
           round(sum(CASE WHEN currency = 'NOK' AND amount BETWEEN 100 AND 500000 THEN round(amount / 11.3125, 2) END), 2) AS total_eur,
           any_value(CASE source_brand WHEN 'iFFALCON' THEN 'TCL' ELSE source_brand END) AS brand_raw
    FROM hits GROUP BY sku""")
def api_items(r):
    return api.hit_items(hits(r)).groupBy("elkjop_sku").agg(
        F.count("*").alias("items"),
        F.count("price_local").alias("priced"),
        F.round(F.sum("price_eur"), 2).alias("total_eur"),
        F.max("brand_raw").alias("brand_raw"),
    )


@query("api_price_rows", """
    SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') AND k * 5.5 BETWEEN 100 AND 500000 THEN k * 5.5 END::DOUBLE AS price,
           CASE WHEN event_type NOT IN ('error', 'view') AND k * 5.5 >= 100 THEN 'NOK' END AS currency
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM {events})""")
def api_price_rows(r):
    """Event properties wrapped as product price responses."""
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.to_json(
        F.array(
            F.struct(
                F.struct(
                    F.struct(
                        F.struct(
                            F.when(F.col("event_type") == "view", "SEK").otherwise("nok").alias("currency"),
                            F.array(k * 5.5, k * 4.4).alias("current"),
                        ).alias("price"),
                        F.struct((F.col("event_type") == "error").alias("isDisabled")).alias("sellability"),
                    ).alias("data")
                ).alias("result")
            )
        )
    )
    captured = r["events"].select(F.col("event_id").cast("string").alias("sku"), body.alias("body"))
    return api.api_prices(captured).select(F.col("sku").cast("long").alias("event_id"), "price", "currency")


@query("valid_hit", f"""
    WITH {_FLAT},
    ruled AS (
        SELECT *, CASE WHEN sku LIKE 'A%' THEN 'sku' WHEN facet_year <> year THEN 'year' WHEN url LIKE '%/other' THEN 'url'
            WHEN source_brand IS NULL THEN 'brand' WHEN currency <> 'NOK' THEN 'currency'
            WHEN amount NOT BETWEEN 100 AND 500000 THEN 'price' END AS rule
        FROM hits)
    SELECT year, page_index, sku, rule, count(*) AS hits FROM ruled WHERE rule IS NOT NULL GROUP BY ALL""")
def valid_hit(r):
    return reconcile.invalid_hits(hits(r)).groupBy("year", "page_index", "sku", "rule").agg(
        F.count("*").alias("hits")
    )


@query("completeness", f"""
    WITH {_FLAT}
    SELECT year, CAST(max(nb_hits) AS INT) AS declared, CAST(max(nb_pages) AS INT) AS declared_pages,
           (SELECT count(DISTINCT sku) FROM hits AS h WHERE h.year = p.year) AS found,
           max(nb_hits) >= 100 AND (SELECT count(DISTINCT sku) FROM hits AS h WHERE h.year = p.year) = max(nb_hits) AS complete
    FROM pages AS p GROUP BY year""")
def completeness(r):
    captured = responses(r)
    return reconcile.completeness(api.api_pages(captured), api.api_hits(captured))


@query("page_drift", f"""
    WITH {_FLAT}
    SELECT year, count(*) AS pages, CAST(min(nb_hits) AS INT) AS min_hits, CAST(max(nb_hits) AS INT) AS max_hits,
           CAST(min(nb_pages) AS INT) AS min_pages, CAST(max(nb_pages) AS INT) AS max_pages,
           min(nb_hits) = max(nb_hits) AND min(nb_pages) = max(nb_pages) AS stable
    FROM pages GROUP BY year""")
def page_drift(r):
    return reconcile.page_drift(api.api_pages(responses(r)))


@query("duplicate_sku", f"""
    WITH {_FLAT}
    SELECT year, sku, count(*) AS times FROM hits GROUP BY ALL HAVING count(*) > 1""")
def duplicate_sku(r):
    return reconcile.duplicate_skus(hits(r))


@query("cross_year_sku", f"""
    WITH {_FLAT}
    SELECT sku, string_agg(DISTINCT CAST(year AS STRING), ',' ORDER BY CAST(year AS STRING)) AS years
    FROM hits GROUP BY sku HAVING count(DISTINCT year) > 1""")
def cross_year_sku(r):
    return reconcile.cross_year_skus(hits(r)).withColumn("years", F.concat_ws(",", F.col("years").cast("array<string>")))


@query("required_brands", f"""
    WITH {_FLAT}
    SELECT source_brand, count(*) AS hits FROM hits GROUP BY source_brand""")
def required_brands(r):
    return reconcile.brand_counts(hits(r))


@query("missing_required", f"""
    WITH {_FLAT}
    SELECT b AS brand FROM (VALUES ('grundig'), ('hisense'), ('lg'), ('samsung'), ('sony'), ('tcl')) AS v(b)
    WHERE b NOT IN (SELECT lower(source_brand) FROM hits WHERE source_brand IS NOT NULL)""")
def missing_required(r):
    """Required brands and one that no response holds."""
    required = reconcile.required_brands(r.spark)
    absent = r.spark.createDataFrame([("grundig",)], required.schema)
    return reconcile.missing_brands(hits(r), required.union(absent))


@query("api_gates", f"""
    WITH {_FLAT},
    ruled AS (
        SELECT *, sku LIKE 'A%' OR facet_year <> year OR url LIKE '%/other' OR source_brand IS NULL OR currency <> 'NOK'
                  OR amount NOT BETWEEN 100 AND 500000 AS broken FROM hits),
    declared AS (
        SELECT year, min(nb_hits) AS low, max(nb_hits) AS high, min(nb_pages) <> max(nb_pages) AS pages_drift,
               (SELECT count(DISTINCT sku) FROM hits AS h WHERE h.year = p.year) AS found
        FROM pages AS p GROUP BY year)
    SELECT 'page_drift' AS gate, count(*) FILTER (low <> high) + count(*) FILTER (pages_drift) AS violations FROM declared
    UNION ALL SELECT 'invalid_hit', count(*) FROM ruled WHERE broken
    UNION ALL SELECT 'duplicate_sku', count(*) FROM (SELECT year, sku FROM hits GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'incomplete', count(*) FROM declared WHERE high < 100 OR found <> high
    UNION ALL SELECT 'cross_year_sku', count(*) FROM (SELECT sku FROM hits GROUP BY sku HAVING count(DISTINCT year) > 1)
    UNION ALL SELECT 'missing_brand', count(*) FROM (VALUES ('hisense'), ('lg'), ('samsung'), ('sony'), ('tcl')) AS v(b)
        WHERE b NOT IN (SELECT lower(source_brand) FROM hits WHERE source_brand IS NOT NULL)""")
def api_gates(r):
    """Every gate of the API capture at once."""
    captured = responses(r)
    return reconcile.api_gates(api.api_pages(captured), api.api_hits(captured))


@query("page_range_check", f"""
    WITH {_FLAT}
    SELECT year, page_index AS page, 48 AS expected, page_hits AS cards,
           CAST(ceil(nb_hits / 48) AS INT) AS total_pages, page_hits = 48 AS consistent
    FROM pages""")
def page_range_check(r):
    captured = responses(r)
    first = F.col("page_index") * 48
    ranges = api.api_pages(captured).select(
        "year", F.col("page_index").alias("page"),
        F.concat(
            (first + 1).cast("string"), F.lit("–"), (first + 48).cast("string"), F.lit(" av "),
            F.col("nb_hits").cast("string"), F.lit(" produkter"),
        ).alias("range_text"),
    )
    cards = api.api_hits(captured).select("year", F.col("page_index").alias("page"))
    return reconcile.page_range_check(ranges, cards)


