"""Coverage gate, drift guard and the gated snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.joins import LATEST_SQL, SNAPSHOT_SQL, latest, snapshot
from pricewatch.bindings.registry import query
from pricewatch.bindings.watch_list import active
from pricewatch.channels import gate_thresholds
from pricewatch.operators import gates
from pricewatch.session import written
from pricewatch.sources.price_log import latest_by

_RATIOS = f"""{SNAPSHOT_SQL}, {LATEST_SQL},
    ratios AS (
        SELECT r.channel, batch_price / old_price AS ratio FROM requested AS r JOIN latest USING (part_no)
        WHERE batch_price IS NOT NULL AND old_price > 0 AND latest.platform = r.platform),
    drift AS (
        SELECT channel, count(*) AS sample, median(ratio) AS median_ratio,
               count(*) FILTER (ratio < 0.4 OR ratio > 2.5) / count(*) AS extreme_share
        FROM ratios GROUP BY channel),
    guarded AS (
        SELECT *, sample < 20 OR (median_ratio BETWEEN 0.75 AND 1.35 AND extreme_share <= 0.05) AS passed FROM drift)"""
_COVERAGE = """
    wanted AS (SELECT DISTINCT channel, batch_key, batch_price IS NOT NULL AS hit FROM requested),
    covered AS (
        SELECT g.channel, (SELECT count(*) FROM snapshot AS s WHERE s.channel = g.channel) AS items,
               count(w.batch_key) AS requested, count(*) FILTER (hit) AS matched, min_items, min_coverage
        FROM (VALUES ('boulanger', 180, 0.5), ('currys', 300, 0.55)) AS g(channel, min_items, min_coverage)
        LEFT JOIN wanted AS w ON w.channel = g.channel GROUP BY ALL),
    judged AS (
        SELECT channel, items, requested, matched, matched / requested AS coverage,
               items >= min_items AND matched / requested >= min_coverage AS passed FROM covered)"""


def _links(r):
    return r.once("active", lambda: active(r))


def _snapshot(r):
    """The snapshot serves both checks and the result."""
    return r.once("snapshot", lambda: written(snapshot(r), "snapshot"))


def _drift(r):
    return gates.drift_guard(_links(r), _snapshot(r), written(latest(r), "latest"))


@query("drift_guard", f"""
    WITH {_RATIOS}
    SELECT channel, sample, round(median_ratio, 9) AS median_ratio, extreme_share, passed FROM guarded""")
def drift_guard(r):
    return _drift(r).withColumn("median_ratio", F.round("median_ratio", 9))


@query("drift_guard_bulk", """
    WITH ratios AS (
        SELECT platform AS channel, unit_cost / last_cost AS ratio FROM (
            SELECT platform, unit_cost, arg_max(unit_cost, (obs_date, seq, unit_cost)) OVER (PARTITION BY product_name) AS last_cost
            FROM {unit_prices}))
    SELECT channel, count(*) AS sample, round(median(ratio), 9) AS median_ratio,
           count(*) FILTER (ratio < 0.4 OR ratio > 2.5) / count(*) AS extreme_share,
           median(ratio) BETWEEN 0.75 AND 1.35
               AND count(*) FILTER (ratio < 0.4 OR ratio > 2.5) / count(*) <= 0.05 AS passed
    FROM ratios GROUP BY channel""")
def drift_guard_bulk(r):
    """Every observation against the latest of its product: a large sample per channel."""
    log = r["unit_prices"]
    last = latest_by(log, ["product_name"], [F.col("obs_date"), F.col("seq")], "unit_cost", "last_cost")
    ratios = log.join(last, "product_name").select(
        F.col("platform").alias("channel"), (F.col("unit_cost") / F.col("last_cost")).alias("ratio")
    )
    return gates.drift_verdict(ratios).withColumn("median_ratio", F.round("median_ratio", 9))


def _coverage(r):
    return gates.coverage_gate(_links(r), _snapshot(r), gate_thresholds(r.spark))


@query("coverage_gate", f"""
    WITH {SNAPSHOT_SQL}, {_COVERAGE}
    SELECT channel, items, requested, matched, coverage, passed FROM judged""")
def coverage_gate(r):
    return _coverage(r)


@query("gated_snapshot", f"""
    WITH {_RATIOS}, {_COVERAGE}
    SELECT s.channel, CAST(CASE s.channel WHEN 'boulanger' THEN 1000000 ELSE 10000000 END + part_no AS STRING) AS batch_key, price
    FROM snapshot AS s JOIN judged AS j ON j.channel = s.channel AND j.passed
    WHERE s.channel NOT IN (SELECT channel FROM guarded WHERE NOT passed)""")
def gated_snapshot(r):
    return gates.gated_snapshot(_snapshot(r), _coverage(r), _drift(r)).select("channel", "batch_key", "price")


