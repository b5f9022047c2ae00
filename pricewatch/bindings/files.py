"""File sources: watch list and price log as CSV files, run logs as text files, written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.fixed_values import PRICE_LOG_CSV_HEADER
from pricewatch.session import new_table_path
from pricewatch.sinks import export_csv, write_log_files
from pricewatch.sources.links import active_links, read_links
from pricewatch.sources.price_log import price_history, read_price_csvs
from pricewatch.sources.run_logs import read_log_files


@query("watch_list_files", """
    SELECT brand, product_name, country, platform, url FROM {expected_links}""")
def watch_list_files(r):
    path = new_table_path(r.spark, "watch-list")
    export_csv(r["links"].drop("part_no").repartition(3), path)
    return active_links(read_links(r.spark, path))


@query("price_csv_files", """
    SELECT platform, obs_date, count(*) AS prices, max(price) AS highest, min(provenance) AS provenance,
           count(*) FILTER (seq % 3 = 0) AS broken_cells
    FROM (SELECT * REPLACE (CASE seq % 3 WHEN 0 THEN concat('a "page"', chr(10), 'of ', platform, ',', chr(10)) ELSE provenance END AS provenance)
          FROM {price_log} WHERE status = 'Success')
    GROUP BY ALL""")
def price_csv_files(r):
    """The price log as CSV files, every third page title with quotes and line breaks."""
    path = new_table_path(r.spark, "price-csv")
    title = F.expr("CASE seq % 3 WHEN 0 THEN concat('a \"page\"', chr(10), 'of ', platform, ',', chr(10)) ELSE provenance END")
    log = r["price_log"].withColumn("provenance", title).withColumn("trend", F.lit("-"))
    export_csv(log.select(*(F.col(ours).alias(theirs) for ours, theirs in PRICE_LOG_CSV_HEADER.items())).repartition(4), path)
    return price_history(read_price_csvs(r.spark, path)).groupBy("platform", "obs_date").agg(
        F.count("*").alias("prices"), F.max("price").alias("highest"), F.min("provenance").alias("provenance"),
        F.count_if(F.contains("provenance", F.lit("\n"))).alias("broken_cells"),
    )


@query("log_files", """
    SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY line_no) AS line_no, line FROM {run_log}""")
def log_files(r):
    """Each run's lines as a text file, read back with their numbers."""
    path = new_table_path(r.spark, "run-logs")
    write_log_files(r["run_log"].selectExpr("run_id", "CAST(line_no AS BIGINT) AS line_no", "line"), path)
    return read_log_files(r.spark, path, r"/run=([^/]+)/")
