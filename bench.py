"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data directory, BENCH_CPUS the number of local cores.
Each query runs once to warm up; the median of three further runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricewatch.bindings import QUERIES  # noqa: E402
from pricewatch.session import build_session, remove_written  # noqa: E402

HEADLINE = (
    "latest_price",
    "latest_price_bulk",
    "trend_join",
    "recompute_trends",
    "recompute_trends_bulk",
    "trim_window_bulk",
    "drift_guard",
    "drift_guard_bulk",
    "gated_snapshot",
    "price_cascade",
    "daily_run",
    "normalize_price_text",
    "structured_page_price",
    "series_detect",
    "card_filter",
    "card_merge",
    "card_merge_longest",
    "text_dedup",
    "line_dedup",
    "fair_pick",
    "recovery_pick",
    "api_hits",
    "completeness",
    "log_pair",
    "manifest_counts",
    "append_success",
    "stop_page",
    "recovered_trends",
    "conflict_gate",
    "price_log_cycle",
    "run_results",
    "catalogue_amazon",
    "catalogue_boulanger",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(lambda: QUERIES[name](spark, sf_dir))
        remove_written(spark)
        times[name] = round(statistics.median(seconds(lambda: QUERIES[name](spark, sf_dir)) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
