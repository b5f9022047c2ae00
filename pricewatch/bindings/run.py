"""Whole runs: the daily monitor, log writers and incremental results."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from pricewatch.bindings.gates import _COVERAGE, _RATIOS
from pricewatch.bindings.joins import _CASCADE, LATEST_SQL, SNAPSHOT_SQL, _api, _page_captures, snapshot
from pricewatch.bindings.log_recovery import _PAIRS, recovered
from pricewatch.bindings.prices import RUN_START, _TREND
from pricewatch.bindings.registry import query
from pricewatch.fixed_values import STATUS_OK
from pricewatch.log_state import read_latest, refresh_latest
from pricewatch.operators.reconcile import run_summary
from pricewatch.plans import monitor
from pricewatch.session import new_table_path, written
from pricewatch.sinks import append_recovered, append_success, drop_expired_days, read_price_log, write_log
from pricewatch.sources.price_log import latest_prices, price_history, successful
from pricewatch.streaming import results as streaming


# The cascade with the batch prices of those channels only that pass both gates.
_GATED = _CASCADE.replace(SNAPSHOT_SQL, f"""{_RATIOS}, {_COVERAGE},
    gated AS (
        SELECT * REPLACE (CASE WHEN channel IN (SELECT channel FROM judged WHERE passed)
            AND channel NOT IN (SELECT channel FROM guarded WHERE NOT passed) THEN batch_price END AS batch_price) FROM requested)""")
_GATED = _GATED.replace("FROM requested AS r JOIN {part}", "FROM gated AS r JOIN {part}")


def _captured(r):
    """Inputs of a daily run; pages carry their prices in their markup."""
    page = (
        "concat('<meta itemprop=\"price\" content=\"', CAST(page_price AS STRING), '\">', "
        "'<meta itemprop=\"priceCurrency\" content=\"', page_currency, '\">')"
    )
    pages = _page_captures(r).withColumn("html", F.expr(page)).withColumn(
        "page_title", F.when(F.col("blocked"), "Just a moment...").otherwise(F.col("page_title"))
    )
    return monitor.Captured(
        links=r["links"],
        history=price_history(r["unit_prices"]),
        snapshot=r.once("snapshot", lambda: written(snapshot(r), "snapshot")),
        api=_api(r),
        pages=pages.drop("page_price", "page_currency", "blocked"),
    )


@query("daily_run", f"""
    WITH observed AS ({_GATED}), {LATEST_SQL}
    SELECT platform, status, CASE WHEN price IS NULL THEN '-' ELSE {_TREND} END AS trend, count(*) AS links
    FROM observed LEFT JOIN latest USING (product_name, platform) GROUP BY ALL""")
def daily_run(r):
    """The gated daily run from captures to classified prices, counted per platform and outcome."""
    return monitor.observe(_captured(r)).groupBy("platform", "status", "trend").agg(F.count("*").alias("links"))


@query("append_success", """
    SELECT obs_date, platform, count(*) AS log_rows, max(price) AS highest FROM {price_log}
    WHERE status = 'Success' GROUP BY obs_date, platform""")
def append_log(r):
    """Successful rows appended to a partitioned log in two runs, one of them repeated, and read back."""
    path = new_table_path(r.spark, "log")
    results = r["price_log"].withColumn("trend", F.lit("-"))
    append_success(results.filter(F.col("obs_date") < RUN_START), path, "first")
    append_success(results.filter(F.col("obs_date") >= RUN_START), path, "second")
    append_success(results.filter(F.col("obs_date") >= RUN_START), path, "second")  # repeated
    return read_price_log(r.spark, path).groupBy("obs_date", "platform").agg(
        F.count("*").alias("log_rows"), F.max("price").alias("highest")
    )


@query("retention_rewrite", """
    SELECT obs_date, count(*) AS log_rows FROM {price_log}
    WHERE CAST(obs_date AS DATE) >= (SELECT max(CAST(obs_date AS DATE)) - 10 FROM {price_log}) GROUP BY obs_date""")
def retention_rewrite(r):
    path = new_table_path(r.spark, "window")
    write_log(r["price_log"].withColumn("trend", F.lit("-")), path, "all")
    drop_expired_days(r.spark, path, 10)
    return read_price_log(r.spark, path).groupBy("obs_date").agg(F.count("*").alias("log_rows"))


def _staged(r, name: str):
    """Event files streamed through staging until none is left."""
    base = new_table_path(r.spark, name)
    schema = r["events"].schema
    arriving = streaming.result_stream(r.spark, schema, r.sf_dir, "events.parquet")
    results = r.over({"events": arriving})["price_log"].withColumn("trend", F.lit("-"))
    stream = streaming.stage_results(results, f"{base}/staging", f"{base}/checkpoint")
    stream.awaitTermination()
    return base, results.schema


@query("progress_checkpoint", """
    SELECT platform, status, count(*) AS completed, count(DISTINCT seq) AS different FROM {price_log} GROUP BY ALL""")
def progress_checkpoint(r):
    base, schema = _staged(r, "progress")
    return streaming.staged(r.spark, f"{base}/staging", schema).groupBy("platform", "status").agg(
        F.count("*").alias("completed"), F.count_distinct("seq").alias("different")
    )


@query("incremental_results", """
    SELECT obs_date, count(*) AS promoted FROM {price_log} WHERE status = 'Success' GROUP BY obs_date""")
def incremental_results(r):
    base, schema = _staged(r, "incremental")
    streaming.promote(r.spark, f"{base}/staging", schema, f"{base}/log", "stream")
    return read_price_log(r.spark, f"{base}/log").groupBy("obs_date").agg(F.count("*").alias("promoted"))


# A day and channel whose repeated run had no success: its rows leave the log.
_FAILED = "(obs_date = '2024-01-05' OR (obs_date = '2024-01-06' AND platform = 'Currys'))"
_CYCLE = f"""{_PAIRS},
    kept AS (SELECT * FROM {{price_log}} WHERE status = 'Success' AND NOT {_FAILED})"""


def _lived(r, name: str, keep_days: int, refresh=lambda *_: None) -> str:
    """A log through its life: a run, the same run again with failures, streamed results, recovery, retention.

    ``refresh`` is called after each step that adds rows to the log.
    """
    base, schema = _staged(r, name)
    log = f"{base}/log"
    early = r["price_log"].withColumn("trend", F.lit("-")).filter(F.col("obs_date") < RUN_START)
    append_success(early, log, "daily")
    refresh(r.spark, log)
    again = F.when(F.expr(_FAILED), "Failed: Price Not Found").otherwise(F.col("status"))
    days = append_success(early.withColumn("status", again), log, "daily")
    refresh(r.spark, log, days[0])
    staged = streaming.staged(r.spark, f"{base}/staging", schema).filter(F.col("obs_date") >= RUN_START)
    days = append_success(staged, log, "stream")
    refresh(r.spark, log, days[0])
    append_recovered(read_price_log(r.spark, log), recovered(r), log, "recovery", write=True)
    drop_expired_days(r.spark, log, keep_days)
    refresh(r.spark, log, days[0])
    return log


@query("price_log_cycle", f"""
    WITH {_CYCLE},
    log AS (SELECT obs_date, platform FROM kept
            UNION ALL SELECT run_date, platform FROM pairs WHERE paired)
    SELECT obs_date, platform, count(*) AS log_rows FROM log
    WHERE CAST(obs_date AS DATE) >= (SELECT max(CAST(obs_date AS DATE)) - 930 FROM log) GROUP BY ALL""")
def price_log_cycle(r):
    log = _lived(r, "cycle", 930)
    return read_price_log(r.spark, log).groupBy("obs_date", "platform").agg(F.count("*").alias("log_rows"))


@query("latest_state", f"""
    WITH {_CYCLE},
    log AS (SELECT product_name, country, platform, obs_date, obs_time, price FROM kept
            UNION ALL SELECT product_name, 'GB', platform, run_date, clock, price FROM pairs WHERE paired)
    SELECT product_name, country, platform, arg_max(price, (obs_date, obs_time, price)) AS old_price
    FROM log WHERE CAST(obs_date AS DATE) >= (SELECT max(CAST(obs_date AS DATE)) - 925 FROM log) GROUP BY ALL""")
def latest_state(r):
    """The maintained latest prices after the log's life, with the first days expired."""
    return read_latest(r.spark, _lived(r, "state", 925, refresh_latest))


@query("stream_trend", f"""
    WITH latest AS (
        SELECT product_name, country, platform, arg_max(price, (obs_date, obs_time, seq)) AS old_price
        FROM {{price_log}} WHERE status = 'Success' AND obs_date < '{RUN_START}' GROUP BY ALL)
    SELECT seq, price, old_price, {_TREND} AS trend
    FROM {{price_log}} LEFT JOIN latest USING (product_name, country, platform)
    WHERE status = 'Success' AND obs_date >= '{RUN_START}'""")
def stream_trend(r):
    """Arriving prices against the history frozen when the run began."""
    base = new_table_path(r.spark, "trends")
    history = latest_prices(successful(r["price_log"]).filter(F.col("obs_date") < RUN_START))
    history.write.mode("overwrite").parquet(f"{base}/history")
    frozen = r.spark.read.parquet(f"{base}/history")
    arriving = streaming.result_stream(r.spark, r["events"].schema, r.sf_dir, "events.parquet")
    run = successful(r.over({"events": arriving})["price_log"]).filter(F.col("obs_date") >= RUN_START)
    trends = streaming.stream_trends(run, frozen)
    stream = streaming.stage_results(trends, f"{base}/staging", f"{base}/checkpoint")
    stream.awaitTermination()
    return streaming.staged(r.spark, f"{base}/staging", trends.schema).select("seq", "price", "old_price", "trend")


@query("run_results", f"""
    SELECT platform, count(*) AS total, count(*) FILTER (status = 'Success') AS ok,
           count(*) FILTER (status <> 'Success') AS failed,
           count(*) FILTER (provenance = 'Batch category snapshot') AS batch_hits
    FROM ({_GATED}) GROUP BY platform""")
def run_results(r):
    return run_summary(monitor.observe(_captured(r)))


@query("daily_monitor", f"""
    SELECT platform, count(*) AS log_rows, max(price) AS highest FROM ({_GATED}) WHERE status = 'Success' GROUP BY platform""")
def daily_monitor(r):
    """The whole daily job, run twice for one day against the latest prices kept beside its log."""
    base = new_table_path(r.spark, "daily")
    stamps = {"obs_date": F.lit("2026-08-05"), "obs_time": F.lit("05:00:00")}
    inputs = _captured(r)
    known = latest_prices(inputs.history).selectExpr("*", "old_price AS price", "'2026-08-01' AS obs_date", f"'{STATUS_OK}' AS status")
    write_log(known, f"{base}/log", "history")
    refresh_latest(r.spark, f"{base}/log")
    run = replace(inputs, history=None)
    for attempt in ("first", "again"):
        monitor.monitor(run, lambda rows: rows.withColumns(stamps), f"{base}/{attempt}", f"{base}/log", keep_days=100_000, day="2026-08-05")
    return read_price_log(r.spark, f"{base}/log", "2026-08-05").groupBy("platform").agg(
        F.count("*").alias("log_rows"), F.max("price").alias("highest")
    )
