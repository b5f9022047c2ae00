"""Slices of the price log, the tables kept beside it, and staged batches."""

from pyspark.sql import functions as F
from test_recovery import LOG, log_row

from pricewatch import sinks
from pricewatch.log_state import closing_path, read_latest, refresh_latest
from pricewatch.operators import recovery
from pricewatch.sources.price_log import latest_prices, price_history
from pricewatch.streaming import results as streaming


def latest_of(rows):
    return sorted((r.product_name, r.old_price) for r in rows.collect()) if rows is not None else []


def scanned(spark, log):
    return latest_of(latest_prices(price_history(sinks.read_price_log(spark, log))))


def test_repeat_without_success_leaves_no_row(spark, tmp_path):
    log = str(tmp_path / "log")
    good = spark.createDataFrame([log_row(1, "2026-08-01", "A", 1.0), log_row(2, "2026-08-02", "A", 2.0)], LOG)
    sinks.append_success(good, log, "daily-all")
    sinks.append_success(good.withColumn("price", F.col("price") * 2), log, "daily-lg")
    failed = good.filter("obs_date = '2026-08-02'").withColumn("status", F.lit("Failed: Dead Link"))
    assert sinks.append_success(failed, log, "daily-all") == ["2026-08-02"]
    rows = sinks.read_price_log(spark, log).collect()
    assert sorted((r.obs_date, r.price) for r in rows) == [("2026-08-01", 1.0), ("2026-08-01", 2.0), ("2026-08-02", 4.0)]
    sinks.append_success(failed, log, "daily-lg")
    assert {r.obs_date for r in sinks.read_price_log(spark, log).collect()} == {"2026-08-01"}
    refresh_latest(spark, log)
    assert latest_of(read_latest(spark, log)) == scanned(spark, log) == [("A", 2.0)]


def test_latest_state_equals_the_scan(spark, tmp_path):
    log = str(tmp_path / "log")
    assert read_latest(spark, log) is None

    def rows(*entries):
        return spark.createDataFrame([log_row(i, day, name, price) for i, (day, name, price) in enumerate(entries)], LOG)

    def same():
        assert latest_of(read_latest(spark, log)) == scanned(spark, log)

    for day in range(1, 7):  # append
        entries = [(f"2026-08-0{day}", f"P{p}", float(day * 10 + p)) for p in range(day, 8)]
        days = sinks.append_success(rows(*entries), log, "daily")
        refresh_latest(spark, log, days[0])
        same()
    days = sinks.append_success(rows(("2026-08-06", "P6", 1.5)), log, "daily")  # repeat
    refresh_latest(spark, log, days[0])
    same()
    assert dict(latest_of(read_latest(spark, log)))["P7"] == 57.0
    assert dict(latest_of(read_latest(spark, log, before="2026-08-05")))["P7"] == 47.0
    days = sinks.append_success(rows(("2026-08-02", "P0", 5.0), ("no date", "P9", 9.0), ("2026-08-02", "P7", 1.0)), log, "recovery")
    refresh_latest(spark, log, days[0])  # an old day, and an undated row
    same()
    assert sinks.drop_expired_days(spark, log, 2) == [f"2026-08-0{d}" for d in (1, 2, 3)]
    same()
    refresh_latest(spark, log, "2026-08-06")
    same()
    assert [n for n, _ in latest_of(read_latest(spark, log))] == ["P4", "P5", "P6", "P7", "P9"]


def test_day_without_a_success_has_no_closing_price(spark, tmp_path):
    log = str(tmp_path / "log")
    row = spark.createDataFrame([log_row(1, "2026-08-01", "A", 1.0)], LOG)
    sinks.write_log(row, log, "daily")
    sinks.write_log(row.withColumn("status", F.lit("Failed: Dead Link")), log, "daily")
    refresh_latest(spark, log)
    assert read_latest(spark, log) is None and not (tmp_path / "log_closing" / "day=2026-08-01").exists()
    assert closing_path(log + "/") == closing_path(log)


def test_trends_from_the_kept_prices(spark):
    rows = spark.createDataFrame([log_row(i, day, n, p) for i, (day, n, p) in enumerate([
        ("2026-08-02", "A", 5.0), ("2026-08-02", "A", 6.0), ("2026-08-03", "A", 6.0), ("2026-08-02", "B", 1.0)])], LOG)
    latest = spark.createDataFrame([("A", "GB", "Currys", 7.0), ("Z", "GB", "Currys", 1.0)], "product_name string, country string, platform string, old_price double")
    got = recovery.recompute_trends(rows, latest=latest).orderBy("seq").collect()
    assert [(r.old_price, r.trend) for r in got] == [(7.0, "DOWN"), (7.0, "DOWN"), (6.0, "FLAT"), (None, "NEW")]


def test_readers_see_whole_batches(spark, tmp_path):
    staging = str(tmp_path / "staging")
    schema = "n int, v string"

    def attempt(name, batch, values):
        spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema).write.parquet(f"{staging}/data/batch={batch}/attempt={name}")

    def seen():
        return sorted(r.v for r in streaming.staged(spark, staging, schema).collect())

    assert seen() == []
    attempt("a", 0, ["x"] * 3)
    assert seen() == []  # written, not yet committed
    streaming.commit(spark, staging, 0, "a")
    streaming.commit(spark, staging, 1, "none")
    (tmp_path / "staging" / "data" / "batch=1" / "attempt=none").mkdir(parents=True)
    assert seen() == ["x"] * 3
    reading = streaming.staged(spark, staging, schema)  # begins before the batch is run again
    attempt("b", 0, ["y"] * 2)
    assert seen() == ["x"] * 3
    streaming.commit(spark, staging, 0, "b")
    assert seen() == ["y"] * 2
    assert [r.v for r in reading.collect()] == ["x"] * 3
    attempt("c", 0, ["z"])
    streaming.commit(spark, staging, 0, "c")
    assert seen() == ["z"] and not (tmp_path / "staging" / "data" / "batch=0" / "attempt=a").exists()
