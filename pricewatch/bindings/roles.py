"""The given tables in the shapes the library works on.

A role is one SELECT that Spark and DuckDB read alike: it only renames, formats and
categorises columns. Roles may build on others. ``{name}`` stands for a table or a role.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricewatch.session import tune

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_PLATFORM_OF = "CASE {0} % 4 WHEN 0 THEN 'Boulanger' WHEN 1 THEN 'Currys' WHEN 2 THEN 'Elkjop' ELSE 'Amazon' END"
_COUNTRY_OF = "CASE {0} % 4 WHEN 0 THEN 'FR' WHEN 1 THEN 'GB' WHEN 2 THEN 'NO' ELSE 'DE' END"
_CURRENCY_OF = "CASE {0} % 4 WHEN 1 THEN 'GBP' WHEN 2 THEN 'NOK' ELSE 'EUR' END"
_ASIN_OF = "concat('B', lpad(CAST({0} AS STRING), 9, '0'))"


def _url_of(key: str, suffix: bool) -> str:
    """Product address; the suffix is the part a batch key must ignore."""
    tail = ("'#avis'", "'.html?src=search'", "'?x=1'") if suffix else ("''", "''", "''")
    return (
        f"CASE {key} % 4 "
        f"WHEN 0 THEN concat('https://www.boulanger.com/ref/', CAST(1000000 + {key} AS STRING), {tail[0]}) "
        f"WHEN 1 THEN concat('https://www.currys.co.uk/products/tv-', CAST(10000000 + {key} AS STRING), {tail[1]}) "
        f"WHEN 2 THEN concat('https://www.elkjop.no/product/tv/', CAST(100000 + {key} AS STRING), {tail[2]}) "
        f"ELSE concat('https://www.amazon.de/dp/', {_ASIN_OF.format(key)}) END"
    )


_BATCH_KEY_OF = (
    "CASE {0} % 4 WHEN 0 THEN CAST(1000000 + {0} AS STRING) WHEN 1 THEN CAST(10000000 + {0} AS STRING) "
    "WHEN 2 THEN concat('https://www.elkjop.no/product/tv/', CAST(100000 + {0} AS STRING), '?x=1') "
    "ELSE concat('https://www.amazon.de/dp/', " + _ASIN_OF + ") END"
)

ROLES = {
    # --- price logs ---
    "price_log": f"""
        SELECT event_id AS seq,
               CAST(CAST(ts AS DATE) AS STRING) AS obs_date,
               substr(CAST(ts AS STRING), 12, 8) AS obs_time,
               CASE user_id % 5 WHEN 0 THEN 'Samsung' WHEN 1 THEN 'LG' WHEN 2 THEN 'TCL'
                    WHEN 3 THEN 'Hisense' ELSE 'Sony' END AS brand,
               concat('TV', CAST(user_id AS STRING)) AS product_name,
               CASE event_id % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'GB' ELSE 'NO' END AS country,
               CASE event_type WHEN 'click' THEN 'Boulanger' WHEN 'view' THEN 'Currys'
                    WHEN 'purchase' THEN 'Elkjop' ELSE 'Amazon' END AS platform,
               value AS price,
               CASE event_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'NOK' END AS currency,
               CASE event_type WHEN 'click' THEN 'Batch category snapshot'
                    WHEN 'purchase' THEN 'Direct API' ELSE 'Product page' END AS provenance,
               CASE event_type WHEN 'error' THEN 'Failed: Price Not Found' ELSE 'Success' END AS status
        FROM {{events}}""",
    "unit_prices": f"""
        SELECT l_orderkey * 8 + l_linenumber AS seq,
               l_partkey AS part_no,
               concat('M', CAST(l_partkey AS STRING)) AS product_name,
               {_COUNTRY_OF.format("l_partkey")} AS country,
               {_PLATFORM_OF.format("l_partkey")} AS platform,
               CAST(CAST(l_shipdate AS DATE) AS STRING) AS obs_date,
               '00:00:00' AS obs_time,
               (500 + l_partkey % 1000) * (1 + l_tax) AS price,
               l_extendedprice / l_quantity AS unit_cost,
               CASE l_linestatus WHEN 'F' THEN 'Success' ELSE 'Pending' END AS status
        FROM {{lineitem}}""",
    # --- watch list and its batch snapshot ---
    "links": f"""
        SELECT p_partkey AS part_no,
               CASE CAST(substr(p_brand, 7) AS INT) % 7 WHEN 0 THEN ' Samsung' WHEN 1 THEN 'LG'
                    WHEN 2 THEN 'TCL' WHEN 3 THEN 'Hisense ' WHEN 4 THEN 'Sony' WHEN 5 THEN 'Philips'
                    ELSE 'Panasonic' END AS brand,
               CASE WHEN p_partkey % 4 = 2 THEN concat('X', CAST(p_partkey AS STRING))
                    WHEN p_size < 20 THEN ''
                    ELSE concat(' M', CAST(p_partkey AS STRING)) END AS sku,
               concat('M', CAST(p_partkey AS STRING)) AS model,
               CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'gb' WHEN 2 THEN 'No' ELSE 'DE' END AS country,
               CASE WHEN p_type = 'PROMO' THEN 'Corner Shop'
                    ELSE {_PLATFORM_OF.format("p_partkey")} END AS platform,
               CASE WHEN p_size = 13 THEN ' ' ELSE {_url_of("p_partkey", True)} END AS url,
               CASE p_type WHEN 'ECONOMY' THEN 'no' WHEN 'LARGE' THEN ' TRUE ' WHEN 'MEDIUM' THEN '1'
                    WHEN 'SMALL' THEN 'Yes' WHEN 'STANDARD' THEN 'true' ELSE 'true' END AS active
        FROM {{part}}""",
    "expected_links": f"""
        SELECT part_no, trim(brand) AS brand,
               CASE WHEN platform = 'Corner Shop' AND part_no % 4 = 2 THEN sku ELSE model END AS product_name,
               {_COUNTRY_OF.format("part_no")} AS country, platform, url,
               lower(platform) AS channel,
               CASE WHEN platform = 'Corner Shop' THEN url ELSE {_BATCH_KEY_OF.format("part_no")} END AS batch_key
        FROM {{links}}
        WHERE active <> 'no' AND url <> ' '""",
    "offers": f"""
        SELECT {_PLATFORM_OF.format("l_partkey")} AS platform,
               {_url_of("l_partkey", False)} AS url,
               {_CURRENCY_OF.format("l_partkey")} AS currency,
               l_partkey AS part_no,
               (500 + l_partkey % 1000) * (1 - l_discount)
                   * CASE WHEN l_returnflag = 'R' AND l_partkey % 4 = 1 THEN 0.3 ELSE 1.0 END AS price_local,
               concat(CAST(CAST(l_shipdate AS DATE) AS STRING), lpad(CAST(l_orderkey AS STRING), 12, '0'),
                      CAST(l_linenumber AS STRING)) AS pos
        FROM {{lineitem}}
        WHERE l_linestatus = 'O'""",
    # --- texts that hold a price ---
    "cents": """
        SELECT p_partkey AS part_no, CAST(round(p_retailprice * 100) AS BIGINT) * (1 + p_size % 3) AS cents
        FROM {part}""",
    "amounts": """
        SELECT part_no, part_no % 6 AS style, CAST(floor(cents / 100) AS BIGINT) AS whole,
               lpad(CAST(cents % 100 AS STRING), 2, '0') AS fraction,
               CASE WHEN cents >= 100000 THEN CAST(CAST(floor(cents / 100000) AS BIGINT) AS STRING) ELSE '' END AS thousands,
               CASE WHEN cents >= 100000 THEN lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS STRING), 3, '0')
                    ELSE CAST(CAST(floor(cents / 100) AS BIGINT) AS STRING) END AS hundreds,
               cents / 100 AS amount
        FROM {cents}""",
    "price_texts": """
        SELECT part_no, style, amount, whole,
               CASE style
                    WHEN 0 THEN concat(thousands, CASE WHEN thousands = '' THEN '' ELSE '.' END, hundreds, ',', fraction, ' €')
                    WHEN 1 THEN concat(thousands, CASE WHEN thousands = '' THEN '' ELSE ' ' END, hundreds, ',', fraction, ' €')
                    WHEN 2 THEN concat('£', thousands, CASE WHEN thousands = '' THEN '' ELSE ',' END, hundreds, '.', fraction)
                    WHEN 3 THEN concat('$', thousands, CASE WHEN thousands = '' THEN '' ELSE ',' END, hundreds, '.', fraction)
                    WHEN 4 THEN concat(thousands, ' ', hundreds, '.- NOK')
                    ELSE concat(thousands, CASE WHEN thousands = '' THEN '' ELSE '.' END, hundreds, ' kr') END AS price_text,
               CASE WHEN style < 4 THEN amount ELSE CAST(whole AS DOUBLE) END AS price,
               CASE style WHEN 2 THEN 'GBP' WHEN 3 THEN 'USD' WHEN 4 THEN 'NOK' WHEN 5 THEN 'NOK' ELSE 'EUR' END AS currency
        FROM {amounts}""",
    # --- catalogue items ---
    "families": """
        SELECT p_partkey AS part_no, p_partkey AS pos, p_size, p_type, p_retailprice,
               CASE CAST(substr(p_brand, 7) AS INT) % 6 WHEN 0 THEN 'Samsung' WHEN 1 THEN 'LG'
                    WHEN 2 THEN 'TCL' WHEN 3 THEN 'Hisense' WHEN 4 THEN 'Sony' ELSE 'Philips' END AS brand,
               CASE p_size % 6 WHEN 0 THEN 43 WHEN 1 THEN 48 WHEN 2 THEN 55 WHEN 3 THEN 65
                    WHEN 4 THEN 75 ELSE 85 END AS inches,
               CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
                    WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END AS line_no
        FROM {part}""",
    "models": """
        SELECT part_no, pos, p_size, p_type, p_retailprice, brand, inches, line_no,
               CASE brand
                    WHEN 'Samsung' THEN CASE line_no WHEN 0 THEN 'S95H' WHEN 1 THEN 'QN90F' WHEN 2 THEN 'S90F'
                         WHEN 3 THEN 'U8000F' WHEN 4 THEN 'Q7F' ELSE 'M70H' END
                    WHEN 'LG' THEN CASE line_no WHEN 0 THEN 'C6' WHEN 1 THEN 'QNED85A' WHEN 2 THEN 'G5'
                         WHEN 3 THEN 'UA75' WHEN 4 THEN 'NU80' ELSE 'B6' END
                    WHEN 'TCL' THEN CASE line_no WHEN 0 THEN 'C8L' WHEN 1 THEN 'C6K PRO' WHEN 2 THEN 'P7K'
                         WHEN 3 THEN 'T6C' WHEN 4 THEN 'X11L' ELSE 'A300 PRO' END
                    WHEN 'Hisense' THEN CASE line_no WHEN 0 THEN 'U7Q PRO' WHEN 1 THEN 'E7S' WHEN 2 THEN 'A6Q'
                         WHEN 3 THEN 'U8S' WHEN 4 THEN 'UR8S' ELSE 'S5Q' END
                    WHEN 'Sony' THEN CASE line_no WHEN 0 THEN 'BRAVIA 8 II' WHEN 1 THEN 'XR80M2' WHEN 2 THEN 'BRAVIA 5'
                         WHEN 3 THEN 'BRAVIA 3' WHEN 4 THEN 'XR70' ELSE 'BRAVIA 9' END
                    ELSE '' END AS series_text
        FROM {families}""",
    "items": f"""
        SELECT part_no, pos, p_size, p_type, p_retailprice, brand AS brand_raw, inches, series_text,
               concat(brand, ' TV ', CAST(inches AS STRING), '" ', series_text, ' Smart',
                      CASE WHEN p_size % 5 = 0 THEN ' 2026' ELSE '' END) AS raw_text,
               CAST(inches AS DOUBLE) AS size_hint_inch,
               CASE WHEN p_size % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice END AS price_local,
               p_size % 4 = 0 AS variant_hint,
               {_ASIN_OF.format("part_no")} AS asin,
               replace(upper(series_text), ' ', '') AS expected_series
        FROM {{models}}""",
    "cards": f"""
        SELECT part_no, p_size,
               lower(brand) AS query, line_no AS query_no,
               CAST(floor(part_no / 48) AS INT) + 1 AS page,
               CAST(part_no % 48 AS INT) AS pos,
               CASE WHEN p_size = 11 THEN '' ELSE {_ASIN_OF.format("(part_no - part_no % 3)")} END AS product_key,
               CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 10 = 1 THEN 'NoName' ELSE brand END AS brand,
               CASE WHEN p_size = 17 THEN concat('Wandhalterung ', brand, ' TV ', CAST(inches AS STRING), ' Zoll')
                    WHEN p_size = 23 THEN concat('Replacement remote for ', brand, ' ', CAST(inches AS STRING), ' inch')
                    WHEN p_size % 9 = 2 THEN concat(brand, ' TV ', series_text)
                    ELSE concat(brand, ' ', CAST(inches AS STRING), ' inch ', series_text, ' Magic Remote TV') END AS title,
               CASE WHEN p_size % 18 = 2 THEN concat(CAST(inches AS STRING), ' inches') ELSE '' END AS size_text,
               concat('£', CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), '.50') AS price_text,
               p_type = 'PROMO' AND p_size < 25 AS sponsored,
               p_size % 4 = 0 AS variant_hint,
               brand AS title_brand, inches
        FROM {{models}}""",
    # --- the listing of one shop: every part is a product of one of two years ---
    "shelf": """
        SELECT part_no, p_size, CAST(100000 + part_no AS STRING) AS sku, CAST(2025 + part_no % 2 AS INT) AS year,
               CAST(floor(floor(part_no / 2) / 48) AS INT) AS page_index, brand, inches, p_retailprice,
               CASE brand WHEN 'Philips' THEN 'iFfalcon' ELSE brand END AS facet_brand
        FROM {families}""",
    # --- captured pages ---
    "captures": """
        SELECT page_id, html, url AS address,
               CASE page_id % 4 WHEN 0 THEN 'Boulanger' WHEN 1 THEN 'Currys' WHEN 2 THEN 'Elkjop' ELSE 'Amazon' END AS platform,
               concat('https://www.currys.co.uk/products/tv-', CAST(10000000 + page_id AS STRING), '.html') AS requested_url,
               CASE page_id % 7 WHEN 1 THEN 'https://www.currys.co.uk/tv-and-audio/televisions/tvs'
                    WHEN 2 THEN concat('https://www.currys.co.uk/products/new-', CAST(10000001 + page_id AS STRING), '.html')
                    ELSE concat('https://www.currys.co.uk/products/renamed-', CAST(10000000 + page_id AS STRING), '.html?src=x')
                    END AS final_url,
               CAST(CASE page_id % 11 WHEN 3 THEN 404 WHEN 5 THEN 410 WHEN 7 THEN 503 ELSE 200 END AS INT) AS http_status,
               length(html) AS html_length
        FROM {pages}""",
    # --- run logs ---
    "run_log": """
        SELECT CAST(conv_id AS STRING) AS run_id, turn + 1 AS line_no, role,
               concat('N', CAST(conv_id % 25 AS STRING)) AS model,
               CASE conv_id % 2 WHEN 0 THEN 'Boulanger' ELSE 'Currys' END AS shop,
               length(text) AS amount,
               concat('2026-08-0', CAST(1 + conv_id % 4 AS STRING)) AS run_date,
               CASE role
                    WHEN 'user' THEN concat('→ [GB] N', CAST(conv_id % 25 AS STRING), ' (',
                         CASE conv_id % 2 WHEN 0 THEN 'Boulanger' ELSE 'Currys' END, ')')
                    WHEN 'assistant' THEN concat('2026-08-0', CAST(1 + conv_id % 4 AS STRING), 'T08:48:',
                         lpad(CAST(turn AS STRING), 2, '0'), '.5Z   [ok/batch] GBP ', CAST(length(text) AS STRING), '.0 (持平)')
                    ELSE concat('2026-08-0', CAST(1 + conv_id % 4 AS STRING), 'T08:00:00Z   [ok] GBP ',
                         CAST(length(text) AS STRING), '.0 (持平)') END AS line
        FROM {conversations}""",
    "mapping": """
        SELECT 'head' AS revision, concat('N', CAST(n_nationkey AS STRING)) AS sku,
               '' AS model, 'gb' AS country,
               CASE s_suppkey % 2 WHEN 0 THEN 'Boulanger' ELSE 'Currys' END AS platform,
               CASE WHEN n_regionkey = 0 AND s_suppkey % 4 < 2 THEN 'TCL' ELSE n_name END AS brand,
               CASE WHEN n_regionkey = 4 THEN 'false' ELSE 'true' END AS active
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    # --- flat search hits ---
    "flat_hits": """
        SELECT o_orderkey, CAST(2025 + o_orderkey % 2 AS INT) AS year,
               CAST(floor(o_orderkey / 96) AS INT) AS page_index,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 10 = 0 THEN concat('A', CAST(o_custkey AS STRING))
                    ELSE CAST(100000 + o_custkey AS STRING) END AS sku,
               CASE o_custkey % 8 WHEN 0 THEN 'Hisense' WHEN 1 THEN 'LG' WHEN 2 THEN 'iFfalcon' WHEN 3 THEN 'samsung'
                    WHEN 4 THEN 'Sony ' WHEN 5 THEN 'TCL' WHEN 6 THEN 'Samsung' ELSE 'Philips' END AS brand,
               CAST(2025 + (o_orderkey + CASE WHEN o_orderstatus = 'P' AND o_custkey % 5 = 1 THEN 1 ELSE 0 END) % 2 AS INT) AS facet_year,
               CAST(20 + o_custkey % 110 AS INT) AS inches,
               o_totalprice AS amount,
               CASE WHEN o_custkey % 9 = 4 THEN 'sek' ELSE 'nok' END AS currency
        FROM {orders}""",
}

_PLACEHOLDER = re.compile(r"\{([a-z_]+)\}")


def _needed(sql: str) -> list[str]:
    """Roles a text uses, dependencies first."""
    found: list[str] = []
    for name in _PLACEHOLDER.findall(sql):
        if name in ROLES:
            for role in [*_needed(ROLES[name]), name]:
                if role not in found:
                    found.append(role)
    return found


def with_roles(sql: str) -> str:
    """SQL text with the roles it names as common table expressions in front."""
    bare = _PLACEHOLDER.sub(r"\1", sql).strip()
    ctes = [f"{name} AS ({_PLACEHOLDER.sub(r'\1', ROLES[name])})" for name in _needed(sql)]
    if not ctes:
        return bare
    head = "WITH " + ",\n".join(ctes)
    return f"{head},\n{bare[5:]}" if bare.upper().startswith("WITH ") else f"{head}\n{bare}"


class Roles:
    """Tables and roles of one data directory as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str, replaced: dict[str, DataFrame] | None = None):
        tune(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self._known = dict(replaced or {})

    def over(self, replaced: dict[str, DataFrame]) -> "Roles":
        """The same roles with some tables read from elsewhere, such as a stream."""
        return Roles(self.spark, self.sf_dir, replaced)

    def __getitem__(self, name: str) -> DataFrame:
        return self.once(name, lambda: self._load(name))

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` returns, built at the first request only."""
        if name not in self._known:
            self._known[name] = build()
        return self._known[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        sql = ROLES[name]
        return self.spark.sql(sql, **{dep: self[dep] for dep in set(_PLACEHOLDER.findall(sql))})
