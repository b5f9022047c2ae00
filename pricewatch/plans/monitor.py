"""Daily price monitoring over captured tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from pricewatch.channels import gate_thresholds
from pricewatch.fixed_values import KEEP_DAYS, SERIES_KEY
from pricewatch.log_state import read_latest, refresh_latest
from pricewatch.operators import gates, match, scope
from pricewatch.operators.reconcile import run_summary
from pricewatch.session import written
from pricewatch.sinks import append_success, drop_expired_days
from pricewatch.sources.captures import page_prices
from pricewatch.sources.links import active_links
from pricewatch.sources.price_log import latest_prices


@dataclass(frozen=True)
class Captured:
    """Inputs of one run; ``latest``, where given, is the maintained state that replaces the history."""

    links: DataFrame
    history: DataFrame | None
    snapshot: DataFrame
    api: DataFrame
    pages: DataFrame
    latest: DataFrame | None = None


def pages_to_read(offers: DataFrame, pages: DataFrame) -> DataFrame:
    """The captures that a run parses: the newest one of each link without a batch or API price."""
    return match.newest_captures(pages, match.unpriced(offers))


def _latest(run: Captured) -> DataFrame:
    """Latest price of each series when the run begins: maintained, or from the history, or none."""
    if run.latest is not None:
        return run.latest
    if run.history is not None:
        return written(latest_prices(run.history), "latest")
    columns = ", ".join(f"{c} string" for c in SERIES_KEY)
    return run.links.sparkSession.createDataFrame([], f"{columns}, old_price double")


def observe(run: Captured, channels: str = "") -> DataFrame:
    """Price, status, provenance and trend of every link in scope.

    Prices come in steps. Links with their keys, the latest prices and the links with their
    batch and API prices are written once each. Only then are pages chosen, for the links
    that are still without a price, and only those are parsed.
    """
    spark = run.links.sparkSession
    links = written(match.with_batch_key(scope.in_channels(active_links(run.links), channels)), "links")
    latest = _latest(run)
    coverage = gates.coverage_gate(links, run.snapshot, gate_thresholds(spark))
    drift = gates.drift_guard(links, run.snapshot, latest)
    snapshot = gates.gated_snapshot(run.snapshot, coverage, drift)
    offers = written(match.offered(links, snapshot, run.api), "offers")
    outcomes = match.page_outcomes(page_prices(pages_to_read(offers, run.pages)))
    return match.trend_join(match.settled(offers, outcomes), latest)


def run_name(channels: str) -> str:
    """Name of the daily run's slice of the log."""
    wanted = sorted(c for c in (part.strip().lower() for part in channels.split(",")) if c)
    return "daily-" + ("_".join(wanted) or "all")


def monitor(run: Captured, stamped, staging: str, log: str, channels: str = "", keep_days: int = KEEP_DAYS,
            day: str | None = None) -> DataFrame:
    """Run once: stage all results, add the successes to the log, trim it, return the summary.

    ``stamped`` adds ``obs_date`` and ``obs_time``. Staging is written first and read back,
    so log and summary see the same results and neither recomputes the joins. A run that
    is repeated for the same channels replaces its rows of the day. Without a history the
    run compares with the latest prices kept beside the log, as they were before ``day``.
    """
    spark = run.links.sparkSession
    if run.history is None and run.latest is None:
        run = replace(run, latest=read_latest(spark, log, day))
    stamped(observe(run, channels)).write.mode("overwrite").parquet(staging)
    results = spark.read.parquet(staging)
    days = append_success(results, log, run_name(channels))
    drop_expired_days(spark, log, keep_days)
    refresh_latest(spark, log, min(days, default=None))
    return run_summary(results)
