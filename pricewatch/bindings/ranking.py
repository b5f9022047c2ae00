"""Seeds, rescue searches and recovery picks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.catalogue import history, items, today
from pricewatch.bindings.registry import query
from pricewatch.operators import match, rank

_BRAND_RANK = """CASE brand_key WHEN 'SAMSUNG' THEN 0 WHEN 'LG' THEN 1 WHEN 'TCL' THEN 2 WHEN 'HISENSE' THEN 3
    WHEN 'SONY' THEN 4 ELSE 5 END"""
_PRIORITY = """
    ranked AS (
        SELECT *, upper(brand_raw) AS brand_key,
               8 * CASE WHEN variant_hint THEN 0 ELSE 1 END
               + 4 * CASE WHEN p_size % 5 = 0 OR expected_series IN ('S95H', 'QN90F', 'U8000F', 'Q7F', 'QNED85A',
                     'C8L', 'C6KPRO', 'P7K', 'X11L') THEN 0 ELSE 1 END
               + 2 * CASE WHEN expected_series <> '' THEN 0 ELSE 1 END
               + CASE WHEN price_local IS NOT NULL THEN 0 ELSE 1 END AS priority
        FROM {items}),
    capped AS (
        SELECT * FROM ranked
        QUALIFY expected_series = '' OR row_number() OVER (
            PARTITION BY brand_key, expected_series ORDER BY priority, pos) <= 2)"""


@query("seed_priority", f"WITH {_PRIORITY} SELECT part_no, CAST(priority AS INT) AS priority FROM ranked")
def seed_priority(r):
    return rank.with_seed_priority(items(r)).select("part_no", "priority")


@query("family_cap", f"WITH {_PRIORITY} SELECT part_no, CAST(priority AS INT) AS priority FROM capped")
def family_cap(r):
    return rank.family_cap(rank.with_seed_priority(items(r))).select("part_no", "priority")


@query("fair_pick", f"""
    WITH {_PRIORITY},
    turns AS (SELECT *, row_number() OVER (PARTITION BY brand_key ORDER BY priority, pos) AS turn FROM capped)
    SELECT part_no, brand_key, CAST(row_number() OVER (ORDER BY turn, {_BRAND_RANK}, brand_key) AS INT) AS pick_no
    FROM turns QUALIFY pick_no <= 40""")
def fair_pick(r):
    return rank.variant_seeds(items(r)).select("part_no", "brand_key", "pick_no")


@query("series_rescue", f"""
    WITH sizes AS (
        SELECT upper(brand_raw) AS brand_key, expected_series AS series, count(DISTINCT inches) AS sizes
        FROM {{items}} WHERE expected_series <> '' AND p_size <= 25 GROUP BY ALL),
    turns AS (SELECT *, row_number() OVER (PARTITION BY brand_key ORDER BY sizes, series) AS turn FROM sizes)
    SELECT lower(concat(brand_key, ' ', series)) AS query, sizes,
           CAST(row_number() OVER (ORDER BY turn, {_BRAND_RANK}, brand_key) AS INT) AS pick_no
    FROM turns QUALIFY pick_no <= 25""")
def series_rescue(r):
    return rank.series_rescue(today(r)).select("query", "sizes", "pick_no")


@query("recovery_pick", f"""
    WITH missing AS (
        SELECT *, upper(brand_raw) AS brand_key FROM {{items}} AS h
        WHERE p_size > 15 AND expected_series <> '' AND NOT EXISTS (
            SELECT 1 FROM {{items}} AS t WHERE t.p_size <= 25 AND t.expected_series = h.expected_series
              AND t.brand_raw = h.brand_raw AND t.inches = h.inches AND t.p_type <> 'LARGE')),
    widths AS (SELECT brand_key, expected_series, count(DISTINCT inches) AS family_width FROM missing GROUP BY ALL),
    turns AS (
        SELECT *, row_number() OVER (PARTITION BY brand_key ORDER BY
            CASE WHEN p_size % 5 = 0 OR (brand_key = 'SAMSUNG' AND expected_series LIKE '%H')
                OR (brand_key = 'TCL' AND expected_series LIKE '%L')
                OR (brand_key = 'LG' AND (expected_series LIKE '%6' OR expected_series LIKE '%B'))
                OR (brand_key = 'HISENSE' AND expected_series LIKE '%S') THEN 0 ELSE 1 END,
            family_width DESC, expected_series, inches, pos) AS turn
        FROM missing JOIN widths USING (brand_key, expected_series))
    SELECT part_no, brand_key, family_width,
           CAST(row_number() OVER (ORDER BY turn, {_BRAND_RANK}, brand_key) AS INT) AS pick_no
    FROM turns QUALIFY pick_no <= 40""")
def recovery_pick(r):
    missing = match.missing_sizes(history(r), today(r).filter("p_type <> 'LARGE'"))
    return rank.recovery_pick(missing).select("part_no", "brand_key", "family_width", F.col("pick_no"))
