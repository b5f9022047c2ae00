"""Catalogue snapshots of earlier days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewatch.fixed_values import SNAPSHOT_LOOKBACK
from pricewatch.functions.attributes import series_of
from pricewatch.functions.once import computed_once
from pricewatch.functions.text import or_empty, strip


def recent_snapshots(items: DataFrame, lookback: int = SNAPSHOT_LOOKBACK) -> DataFrame:
    """Newest snapshot dates of each country, last valid row per ASIN.

    Dates are reduced to one row each before they are ranked. The few newest days per
    country are then broadcast, which prunes the partitions of a table stored by date.
    """
    dates = items.groupBy("country", "snapshot_date").agg(F.count("*").alias("__n"))
    newest = dates.groupBy("country").agg(
        F.slice(F.sort_array(F.collect_list("snapshot_date"), asc=False), 1, lookback).alias("__days")
    )
    kept = newest.select("country", F.explode("__days").alias("snapshot_date"))
    valid = (
        items.join(F.broadcast(kept), ["country", "snapshot_date"], "left_semi")
        .withColumn("asin", F.upper(strip(or_empty(F.col("asin")))))
        .filter(
            (F.col("asin") != "")
            & (strip(or_empty(F.col("raw_text"))) != "")
            & (strip(or_empty(F.col("brand_raw"))) != "")
            & (F.coalesce(F.col("size_hint_inch"), F.lit(0.0)) != 0)
        )
    )
    series = series_of(F.col("brand_raw"), F.col("raw_text"))
    valid = computed_once(valid, {"series": series}).filter(F.col("series") != "")
    carried = [c for c in valid.columns if c not in ("country", "asin", "snapshot_date", "pos")]
    last = F.max(F.struct("snapshot_date", "pos", *carried)).alias("__row")
    return valid.groupBy("country", "asin").agg(last).select("country", "asin", "__row.*")
