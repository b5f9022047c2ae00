"""Tables kept beside the price log, so that a day's job need not read the whole log.

``<log>_closing`` holds the last price of each series for every slice (day and run) of the
log, and is written with the slice. ``<log>_latest`` holds, for each of the newest days,
the latest price of each series through that day. A day's table is the one before merged
with the closing prices of the day, so a new, repeated or emptied slice costs its own days
and those after it, and a recovered old day at most one pass over the closing prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewatch.fixed_values import SERIES_KEY
from pricewatch.folders import NO_VALUE, partitions, remove
from pricewatch.sources.price_log import successful

#: Newest days whose table of latest prices is kept.
KEEP_STATES = 3
_ORDER = ("obs_date", "obs_time", "price")


def closing_path(log: str) -> str:
    return f"{log.rstrip('/')}_closing"


def latest_path(log: str) -> str:
    return f"{log.rstrip('/')}_latest"


def write_closing(spark: SparkSession, log: str, days: list[str], run: str) -> None:
    """Write the closing prices of a run's slices; ``days`` are the names of their folders."""
    if not days:
        return
    slices = spark.read.option("basePath", log).parquet(*(f"{log}/day={day}/run={run}" for day in days))
    last = F.max(F.struct(*_ORDER)).alias("__last")
    closing = successful(slices).groupBy(*SERIES_KEY, F.col("day").cast("string").alias("day")).agg(last)
    rows = closing.select(*SERIES_KEY, *(f"__last.{c}" for c in _ORDER), "day", F.lit(run).alias("run"))
    rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "day", "run"
    ).parquet(closing_path(log))


def _closing(spark: SparkSession, log: str, days: list[str]) -> DataFrame:
    base = closing_path(log)
    rows = spark.read.option("basePath", base).parquet(*(f"{base}/day={day}" for day in days))
    return rows.select(*SERIES_KEY, *_ORDER, F.col("day").cast("string").try_cast("date").alias("day"))


def _merged(rows: DataFrame) -> DataFrame:
    last = F.max(F.struct(*_ORDER, "day")).alias("__last")
    return rows.groupBy(*SERIES_KEY).agg(last).select(*SERIES_KEY, *(f"__last.{c}" for c in (*_ORDER, "day")))


def refresh_latest(spark: SparkSession, log: str, since: str | None = None, keep: int = KEEP_STATES) -> None:
    """Bring the tables of latest prices up to date after slices of ``since`` and later have changed."""
    days = [d for d in partitions(spark, closing_path(log), "day") if d != NO_VALUE]
    base = latest_path(log)
    known = set(partitions(spark, base, "through"))
    for day in known - set(days[-keep:]):
        remove(spark, f"{base}/through={day}")
    known &= set(days[-keep:])
    if since is None:
        known = set()
    for at, day in enumerate(days):
        if at < len(days) - keep or (day in known and day < since):
            continue
        earlier = days[at - 1] if at else None
        if earlier in known:
            rows = spark.read.parquet(f"{base}/through={earlier}").unionByName(_closing(spark, log, [day]))
        else:
            rows = _closing(spark, log, days[: at + 1])
        _merged(rows).write.mode("overwrite").parquet(f"{base}/through={day}")
        known.add(day)


def read_latest(spark: SparkSession, log: str, before: str | None = None) -> DataFrame | None:
    """Latest price of each series in the log, or as it was before a day; None for an empty log.

    Prices of days that retention has removed are left out, as the log no longer has them.
    """
    logged = partitions(spark, closing_path(log), "day")
    days = [d for d in logged if d != NO_VALUE and (before is None or d < before)]
    parts = []
    if days:
        path = f"{latest_path(log)}/through={days[-1]}"
        kept = days[-1] in partitions(spark, latest_path(log), "through")
        rows = spark.read.parquet(path) if kept else _merged(_closing(spark, log, days))
        parts.append(rows.filter(F.col("day") >= F.lit(days[0]).cast("date")))
    if NO_VALUE in logged:
        parts.append(_closing(spark, log, [NO_VALUE]))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else _merged(parts[0].unionByName(parts[1]))
    return rows.select(*SERIES_KEY, F.col("price").alias("old_price"))
