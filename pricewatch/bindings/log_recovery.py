"""Run logs, brand mapping and recovered price rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.functions.logs import time_of
from pricewatch.log_state import read_latest, refresh_latest
from pricewatch.operators import reconcile, recovery
from pricewatch.session import new_table_path, written
from pricewatch.sinks import append_recovered, read_price_log, write_log, write_recovery
from pricewatch.sources.links import brand_map as read_brands
from pricewatch.sources.run_logs import log_lines as number_lines


def lines(r):
    return r["run_log"].selectExpr("run_id", "'head' AS revision", "run_date", "line_no", "line")


def pairs(r):
    return recovery.log_pairs(recovery.log_fields(lines(r)))


@query("log_lines", r"""
    WITH split AS (SELECT conv_id, turn, string_split(regexp_replace(text, '\n\z', ''), chr(10)) AS parts
                   FROM {conversations} WHERE text <> '')
    SELECT conv_id, turn, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS line FROM split""")
def log_lines(r):
    return number_lines(r["conversations"].selectExpr("conv_id", "turn", "text AS body"))


@query("log_fields", """
    SELECT run_id, line_no, CASE role WHEN 'user' THEN 'PRODUCT' WHEN 'assistant' THEN 'PRICE' ELSE 'UNNAMED' END AS kind,
           CASE WHEN role = 'user' THEN model END AS product_name, CASE WHEN role = 'user' THEN shop END AS platform,
           CASE WHEN role = 'assistant' THEN amount END::DOUBLE AS price, CASE WHEN role = 'assistant' THEN '持平' END AS logged_trend,
           CASE role WHEN 'user' THEN '00:00:00' WHEN 'assistant' THEN concat('08:48:', lpad(CAST(line_no - 1 AS STRING), 2, '0'))
                ELSE '08:00:00' END AS clock
    FROM {run_log}""")
def log_fields(r):
    return recovery.log_fields(lines(r)).select(
        "run_id", "line_no", "kind", "product_name", "platform", "price", "logged_trend",
        time_of(F.col("logged_at")).alias("clock"),
    )


_PAIRS = """
    events AS (SELECT *, lag(role) OVER (PARTITION BY run_id ORDER BY line_no) AS before,
                      lag(model) OVER (PARTITION BY run_id ORDER BY line_no) AS named,
                      lag(shop) OVER (PARTITION BY run_id ORDER BY line_no) AS sold_at
               FROM {run_log} WHERE role <> 'system'),
    pairs AS (SELECT run_id, run_date, line_no, CAST(amount AS DOUBLE) AS price, coalesce(before = 'user', false) AS paired,
                     concat('08:48:', lpad(CAST(line_no - 1 AS STRING), 2, '0')) AS clock,
                     CASE WHEN before = 'user' THEN named END AS product_name, CASE WHEN before = 'user' THEN sold_at END AS platform
              FROM events WHERE role = 'assistant')"""


@query("log_pair", f"WITH {_PAIRS} SELECT run_id, line_no, product_name, platform, price, paired FROM pairs")
def log_pair(r):
    return pairs(r).select("run_id", "line_no", "product_name", "platform", "price", "paired")


@query("excluded_lines", """
    SELECT run_id, line_no, concat(run_date, 'T08:00:00Z') AS logged_at, line AS raw_line FROM {run_log} WHERE role = 'system'""")
def excluded_lines(r):
    return recovery.excluded_lines(lines(r)).select("run_id", "line_no", "logged_at", "raw_line")


_BRANDS = """
    brands AS (SELECT sku AS product_name, platform, min(brand) AS brand, count(DISTINCT brand) AS brands
               FROM {mapping} WHERE active = 'true' GROUP BY ALL)"""


@query("brand_map", f"WITH {_BRANDS} SELECT 'head' AS revision, product_name, 'GB' AS country, platform, brand, brands FROM brands")
def brand_map(r):
    return read_brands(r["mapping"])


@query("brand_unique", f"WITH {_BRANDS} SELECT product_name, platform, brands FROM brands WHERE brands <> 1")
def brand_unique(r):
    return read_brands(r["mapping"]).filter("brands <> 1").select("product_name", "platform", "brands")


_BRANDED = f"{_PAIRS}, {_BRANDS}, branded AS (SELECT p.*, b.brand FROM pairs AS p LEFT JOIN brands AS b USING (product_name, platform))"


def branded(r):
    return recovery.brand_lookup(pairs(r).filter("paired"), read_brands(r["mapping"]))


@query("brand_lookup", f"""
    WITH {_BRANDED} SELECT run_id, line_no, brand, brand IS NULL AS missing FROM branded WHERE paired""")
def brand_lookup(r):
    return branded(r).select("run_id", "line_no", "brand", F.col("brand").isNull().alias("missing"))


@query("expected_counts", f"""
    WITH {_PAIRS},
    actual AS (SELECT run_id, platform, count(*) AS actual FROM pairs WHERE paired GROUP BY ALL),
    wanted AS (SELECT run_id, shop AS platform, count(*) FILTER (role = 'assistant') AS expected FROM {{run_log}} GROUP BY ALL)
    SELECT run_id, platform, actual, expected, actual IS NOT DISTINCT FROM expected AS matches
    FROM actual FULL JOIN wanted USING (run_id, platform)""")
def expected_counts(r):
    expected = r["run_log"].groupBy("run_id", F.col("shop").alias("platform")).agg(
        F.count_if(F.col("role") == "assistant").alias("expected")
    )
    return reconcile.expected_counts(pairs(r).filter("paired"), expected)


def recovered(r):
    rows = recovery.recovered_rows(branded(r))
    return recovery.recompute_trends(rows, order=recovery.line_order())


@query("recovered_trends", f"""
    WITH {_PAIRS},
    based AS (SELECT *, arg_max(price, (run_date, CAST(run_id AS BIGINT), line_no)) OVER (
                  PARTITION BY product_name, platform ORDER BY CAST(run_date AS DATE)
                  RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS old_price
              FROM pairs WHERE paired)
    SELECT run_id, line_no, CASE WHEN old_price IS NULL THEN 'NEW' WHEN price < old_price THEN 'DOWN'
           WHEN price > old_price THEN 'UP' ELSE 'FLAT' END AS trend FROM based""")
def recovered_trends(r):
    return recovered(r).select("run_id", "line_no", "trend")


@query("recovered_trends_logged", f"""
    WITH {_PAIRS},
    logged AS (SELECT product_name, platform, arg_max(floor(price / 2) * 2, (run_date, clock, floor(price / 2) * 2)) AS known
               FROM pairs WHERE paired AND run_date < '2026-08-04' AND product_name < 'N2' GROUP BY ALL),
    based AS (SELECT p.*, coalesce(arg_max(price, (run_date, CAST(run_id AS BIGINT), line_no)) OVER (
                  PARTITION BY p.product_name, p.platform ORDER BY CAST(run_date AS DATE)
                  RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING), known) AS old_price
              FROM pairs AS p LEFT JOIN logged USING (product_name, platform) WHERE paired)
    SELECT run_id, line_no, old_price, CASE WHEN old_price IS NULL THEN 'NEW' WHEN price < old_price THEN 'DOWN'
           WHEN price > old_price THEN 'UP' ELSE 'FLAT' END AS trend FROM based""")
def recovered_trends_logged(r):
    """Recovered rows against the latest prices kept beside a log of July; the log's rows are not read."""
    log = new_table_path(r.spark, "logged")
    rows = written(recovery.recovered_rows(branded(r)), "recovered")
    july = rows.filter("obs_date < '2026-08-04' AND product_name < 'N2'").withColumns(
        {"obs_date": F.regexp_replace("obs_date", "-08-", "-07-"), "price": F.floor(F.col("price") / 2) * 2.0}
    )
    write_log(july, log, "daily")
    refresh_latest(r.spark, log)
    first_day = rows.agg(F.min("obs_date")).first()[0]
    known = read_latest(r.spark, log, before=first_day)
    trends = recovery.recompute_trends(rows, order=recovery.line_order(), latest=known)
    return trends.select("run_id", "line_no", "old_price", "trend")


@query("manifest_counts", """
    WITH hashed AS (SELECT obs_date, platform, sha256(concat('v', CAST(seq AS STRING), chr(31), 'v', product_name, chr(31), 'v', country)) AS h
                    FROM {price_log} WHERE status = 'Success')
    SELECT obs_date, platform, count(*) AS recovered_rows, concat_ws(':',
           CAST(sum(CAST(concat('0x', substr(h, 1, 16)) AS HUGEINT)) AS STRING), CAST(sum(CAST(concat('0x', substr(h, 17, 16)) AS HUGEINT)) AS STRING),
           CAST(sum(CAST(concat('0x', substr(h, 33, 16)) AS HUGEINT)) AS STRING), CAST(sum(CAST(concat('0x', substr(h, 49, 16)) AS HUGEINT)) AS STRING)) AS digest
    FROM hashed GROUP BY obs_date, platform""")
def manifest_counts(r):
    log = r["price_log"].filter("status = 'Success'")
    return reconcile.manifest_counts(log, ["seq", "product_name", "country"])


@query("recovery_outputs", f"""
    WITH {_PAIRS}
    SELECT run_date AS obs_date, platform, count(*) AS recovered_rows, (SELECT count(*) FROM {{run_log}} WHERE role = 'system') AS excluded_rows
    FROM pairs WHERE paired GROUP BY ALL""")
def recovery_outputs(r):
    """Audit, excluded and manifest tables, written and read back."""
    path = new_table_path(r.spark, "recovery")
    write_recovery(recovered(r), recovery.excluded_lines(lines(r)), path)
    manifest = r.spark.read.json(f"{path}/manifest", schema="obs_date string, platform string, recovered_rows long, digest string")
    excluded = r.spark.read.parquet(f"{path}/excluded").agg(F.count("*")).scalar()
    return manifest.select("obs_date", "platform", "recovered_rows", excluded.alias("excluded_rows"))


def _existing(r):
    return r["price_log"].withColumn("trend", F.lit("-"))


@query("conflict_gate", """
    SELECT platform, obs_date, count(*) AS conflicts FROM {price_log}
    WHERE platform IN ('Boulanger', 'Currys')
      AND obs_date IN (SELECT concat('2024-01', substr(run_date, 8)) FROM {run_log} WHERE role = 'assistant') GROUP BY ALL""")
def conflict_gate(r):
    """Log rows on the recovered days, moved into the month that the log covers."""
    moved = F.concat(F.lit("2024-01"), F.substring("obs_date", 8, 3))
    days = recovery.recovered_rows(branded(r)).select(moved.alias("obs_date"))
    return recovery.conflicting_rows(r["price_log"], days).groupBy(
        "platform", "obs_date"
    ).agg(F.count("*").alias("conflicts"))


@query("recovery_append", f"""
    WITH {_PAIRS}, both_logs AS (
        SELECT platform, status FROM {{price_log}} UNION ALL SELECT platform, 'Success' FROM pairs WHERE paired)
    SELECT platform, status, count(*) AS log_rows FROM both_logs GROUP BY ALL""")
def recovery_append(r):
    """Recovered days added to the log; the gate finds no common day."""
    path = new_table_path(r.spark, "recovered-log")
    write_log(_existing(r), path, "existing")
    append_recovered(read_price_log(r.spark, path), recovered(r), path, "recovered", write=True)
    return read_price_log(r.spark, path).groupBy("platform", "status").agg(F.count("*").alias("log_rows"))
