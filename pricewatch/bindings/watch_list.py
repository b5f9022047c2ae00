"""Watch list, scopes and product identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.channels import batch_key, by_channel
from pricewatch.functions.identity import boulanger_url, elkjop_url
from pricewatch.operators import scope
from pricewatch.sources import links as watch


def active(r):
    return watch.active_links(r["links"])


@query("active_links", "SELECT brand, product_name, country, platform, url FROM {expected_links}")
def active_links(r):
    return active(r)


@query("links_audit", """
    SELECT count(*) AS total_rows, count(*) FILTER (active <> 'no') AS active_rows,
           count(*) FILTER (active <> 'no' AND url = ' ') AS active_without_url,
           count(*) FILTER (active <> 'no' AND url <> ' ') AS usable_rows,
           count(*) FILTER (active <> 'no' AND url <> ' ') > 0 OR count(*) FILTER (active <> 'no') = 0 AS usable_ok
    FROM {links}
    UNION ALL
    SELECT count(*), count(*) FILTER (active <> 'no'), count(*) FILTER (active <> 'no'), 0, count(*) FILTER (active <> 'no') = 0
    FROM {links} WHERE url = ' '""")
def links_audit(r):
    """The whole list, and the rows without an address, which alone are no usable list."""
    return watch.links_audit(r["links"]).union(watch.links_audit(r["links"].filter("url = ' '")))


@query("channel_scope", """
    SELECT product_name, platform FROM {expected_links} WHERE platform IN ('Currys', 'Elkjop')""")
def channel_scope(r):
    return scope.in_channels(active(r), " currys, ELKJOP,").select("product_name", "platform")


@query("market_scope", """
    SELECT platform, country, count(*) AS links FROM {expected_links}
    WHERE (platform = 'Amazon' AND country = 'DE') OR platform = 'Currys' GROUP BY ALL""")
def market_scope(r):
    keyed = active(r).withColumn(
        "registry_key", F.lower(F.concat_ws("_", F.col("platform"), F.col("country")))
    )
    return scope.in_markets(keyed, "Amazon_DE,currys").groupBy("platform", "country").agg(
        F.count("*").alias("links")
    )


@query("runnable_links", "SELECT product_name, platform FROM {expected_links} WHERE platform <> 'Corner Shop'")
def runnable_links(r):
    return scope.runnable(active(r)).select("product_name", "platform")


@query("skipped_platforms", """
    SELECT platform, count(*) AS skipped FROM {expected_links} WHERE platform = 'Corner Shop' GROUP BY platform""")
def skipped_platforms(r):
    return scope.skipped_platforms(active(r))


@query("url_identity", "SELECT product_name, batch_key FROM {expected_links}")
def url_identity(r):
    return active(r).select("product_name", batch_key(F.col("platform"), F.col("url")).alias("batch_key"))


@query("channel_rules", """
    SELECT product_name, CASE platform WHEN 'Boulanger' THEN 'EUR' WHEN 'Currys' THEN 'GBP' WHEN 'Elkjop' THEN 'NOK'
               WHEN 'Amazon' THEN 'EUR' END AS currency,
           CASE WHEN platform <> 'Corner Shop' THEN platform IN ('Boulanger', 'Currys') END AS batch_prices,
           CASE platform WHEN 'Boulanger' THEN string_split(url, '#')[1] WHEN 'Currys' THEN string_split(url, '?')[1]
               WHEN 'Elkjop' THEN string_split(url, '?')[1] WHEN 'Amazon' THEN url END AS address
    FROM {expected_links}""")
def channel_rules(r):
    """Registry entries applied to a whole table; an unregistered platform gets nothing."""
    platform, url = F.col("platform"), F.col("url")
    return active(r).select(
        "product_name",
        by_channel(platform, lambda c: F.lit(c.currency)).alias("currency"),
        by_channel(platform, lambda c: F.lit(c.batch_prices)).alias("batch_prices"),
        by_channel(platform, lambda c: c.canonical_url(url)).alias("address"),
    )


@query("canonical_url", r"""
    SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS bare_url,
           string_split(url, '#')[1] AS anchorless_url
    FROM {pages}""")
def canonical_url(r):
    return r["pages"].select(
        "page_id",
        elkjop_url(F.col("url")).alias("bare_url"),
        boulanger_url(F.col("url")).alias("anchorless_url"),
    )
