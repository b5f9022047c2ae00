"""Price log: reading, normalising and finding the latest price of each series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewatch.fixed_values import PRICE_LOG_CSV_HEADER, SERIES_KEY, STATUS_OK
from pricewatch.functions.text import to_number
from pricewatch.sources.csv_files import read_csv_by_header

RECENCY = ("file_mtime", "obs_date", "obs_time", "seq")


def read_price_csvs(spark: SparkSession, glob: str) -> DataFrame:
    """Every price CSV of the pattern under our column names, with the file's time."""
    raw = read_csv_by_header(spark, glob)
    renamed = [
        (F.col(f"`{theirs}`") if theirs in raw.columns else F.lit(None).cast("string")).alias(ours)
        for ours, theirs in PRICE_LOG_CSV_HEADER.items()
    ]
    return raw.select(*renamed, "file_mtime")


def successful(log: DataFrame) -> DataFrame:
    """Success rows whose price is a number."""
    price = F.col("price")
    if dict(log.dtypes)["price"] == "string":
        price = to_number(price)
    return (
        log.filter(F.col("status") == STATUS_OK)
        .withColumn("price", price)
        .filter(F.col("price").isNotNull())
    )


def price_history(*logs: DataFrame) -> DataFrame:
    """Union of logs, reduced to usable success rows."""
    first, *rest = (successful(log) for log in logs)
    for log in rest:
        first = first.unionByName(log, allowMissingColumns=True)
    return first


def latest_by(rows: DataFrame, keys, order: list[Column], value: str, alias: str) -> DataFrame:
    """The value of the latest row per key, combined on the map side.

    One struct maximum carries order and value, so a series that holds a third of the
    log still leaves each task as a single row.
    """
    newest = F.max(F.struct(*order, F.col(value).alias("__value")))
    return rows.groupBy(*keys).agg(newest.getField("__value").alias(alias))


def latest_prices(history: DataFrame) -> DataFrame:
    """Latest successful price of each series: by file time, then date, time and sequence."""
    order = [F.col(c) for c in RECENCY if c in history.columns]
    return latest_by(history, SERIES_KEY, order, "price", "old_price")
