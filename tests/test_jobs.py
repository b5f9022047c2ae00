"""Sinks, streaming and whole jobs."""

import json

import pytest
from pyspark.sql import functions as F
from test_recovery import LOG, log_row
from test_sources import hit, page

from pricewatch import sinks
from pricewatch.operators import match, retention, scope
from pricewatch.plans import catalogue, monitor
from pricewatch.sources.run_logs import read_log_files
from pricewatch.streaming import results as streaming


def test_append_and_trim(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([log_row(1, "2026-08-01", "A", 1.0), log_row(2, "2026-08-01", "B", None, "Failed: Dead Link")], LOG)
    sinks.append_success(rows, log, "a")
    for _ in range(2):  # a repeated run replaces its rows
        sinks.append_success(rows.withColumn("obs_date", F.lit("2026-08-02")).drop("trend"), log, "b")
    sinks.append_success(rows.withColumn("obs_date", F.lit("no date")), log, "c")
    back = sinks.read_price_log(spark, log)
    assert sorted((r.obs_date, r.product_name, r.trend) for r in back.collect()) == [("2026-08-01", "A", "-"), ("2026-08-02", "A", None), ("no date", "A", "-")]
    assert sorted(r.obs_date for r in sinks.read_price_log(spark, log, since="2026-08-02").collect()) == ["2026-08-02", "no date"]
    assert sinks.drop_expired_days(spark, log, 1) == []
    assert sinks.drop_expired_days(spark, log, 0) == ["2026-08-01"]
    assert sinks.drop_expired_days(spark, str(tmp_path / "none"), 0) == []
    back = sinks.read_price_log(spark, log)
    assert sorted(r.obs_date for r in back.collect()) == ["2026-08-02", "no date"]
    sinks.export_csv(back, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_log_files_are_written_by_several_tasks(spark, tmp_path):
    rows = [(f"r{i}", n, f"r{i} line {n}") for i in range(40) for n in (3, 1, 2)]
    path = str(tmp_path / "logs")
    sinks.write_log_files(spark.createDataFrame(rows, "run_id string, line_no long, line string").coalesce(1), path)
    files = [f.name for f in (tmp_path / "logs").rglob("*.txt")]
    assert len(files) == 40 and len({name[:10] for name in files}) > 1
    back = read_log_files(spark, path, r"/run=([^/]+)/").collect()
    assert sorted(map(tuple, back)) == sorted(rows)


def test_trim_window(spark):
    days = ["2026-08-31", "2026-7-17", "2026-07-16", "bad", "", None]
    df = spark.createDataFrame([(d,) for d in days], "obs_date string")
    assert [r.obs_date for r in retention.trim_window(df).collect()] == ["2026-08-31", "2026-7-17", "bad", "", None]
    assert retention.trim_window(df.filter("obs_date IN ('bad', '')")).count() == 2
    real = df.select(F.try_to_date("obs_date", "yyyy-M-d").alias("obs_date"))
    assert retention.trim_window(real).count() == 5


def test_catalog_snapshot_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "catalog")

    def items(day, count, country="DE"):
        return spark.range(count).selectExpr(
            "'LG' AS brand_raw", "concat('TV ', id) AS raw_text", "'u' AS url", "55.0D AS size_hint_inch", "'Amazon' AS platform",
            f"'{country}' AS country", f"TIMESTAMP '{day} 05:00:00' AS scraped_at", "'B1' AS asin",
        )

    sinks.write_catalog(items("2026-08-01", 3), path)
    sinks.write_catalog(items("2026-08-02", 5), path)
    sinks.write_catalog(items("2026-08-02", 2), path)
    sinks.write_catalog(items("2026-08-02", 4, "GB"), path)
    sinks.write_catalog(items("2026-08-03", 0), path)
    got = spark.read.parquet(path).groupBy("country", "snapshot_date").count().collect()
    assert {(r.country, str(r.snapshot_date)): r["count"] for r in got} == {("DE", "2026-08-01"): 3, ("DE", "2026-08-02"): 2, ("GB", "2026-08-02"): 4}


def test_recovered_rows_are_appended_once(spark, tmp_path):
    existing = spark.createDataFrame([log_row(1, "2026-07-31", "A", 1.0)], LOG)
    recovered = spark.createDataFrame([log_row(2, "2026-08-01", "A", 2.0)], LOG)
    path = str(tmp_path / "log")
    sinks.write_log(existing, path, "daily")
    existing = sinks.read_price_log(spark, path)
    assert not sinks.append_recovered(existing, recovered, path, "recovery")
    assert sinks.append_recovered(existing, recovered, path, "recovery", write=True)
    combined = sinks.read_price_log(spark, path)
    assert combined.count() == 2
    with pytest.raises(sinks.RecoveryConflict):
        sinks.append_recovered(combined, recovered, path, "again", write=True)
    sinks.write_recovery(recovered, existing.limit(0), str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit" / "manifest")).first().recovered_rows == 1


def test_results_are_staged_and_promoted(spark, tmp_path):
    arriving, staging, state, log = (str(tmp_path / d) for d in ("in", "staging", "state", "log"))
    rows = spark.createDataFrame([log_row(i, "", "A", 1.0, "Success" if i % 2 else "Failed: Dead Link") for i in range(6)], LOG).drop("obs_date", "obs_time")

    def run():
        stream = streaming.result_stream(spark, rows.schema, arriving)
        streaming.stage_results(stream, staging, state).awaitTermination()

    rows.coalesce(1).write.parquet(arriving)
    run()
    full = streaming.stamped(rows).schema
    assert streaming.staged(spark, staging, full).count() == 6
    run()
    assert streaming.staged(spark, staging, full).count() == 6
    rows.withColumn("seq", F.col("seq") + 10).coalesce(1).write.mode("append").parquet(arriving)
    run()
    done = streaming.staged(spark, staging, full)
    assert (done.count(), done.filter("obs_date IS NULL OR obs_time IS NULL").count()) == (12, 0)
    sinks.append_success(done.withColumn("obs_date", F.lit("2026-08-01")), log, "daily")
    for _ in range(2):
        streaming.promote(spark, staging, full, log, "stream")
    assert sinks.read_price_log(spark, log).count() == 12


def test_scopes(spark):
    links = spark.createDataFrame([("Currys",), (" currys ",), ("Amazon",), ("Nowhere",), (None,)], "platform string")
    assert scope.in_channels(links, "").count() == 5
    assert scope.in_channels(links, " CURRYS , x").count() == 2
    assert scope.runnable(links).count() == 3
    from pricewatch.schemas import catalog_markets

    markets = catalog_markets(spark)
    assert scope.in_markets(markets, "amazon").count() == 4
    assert scope.in_markets(markets, "Amazon_DE, elkjop").count() == 2
    assert scope.in_markets(markets, "boulanger_fr").count() == 1


def captured(spark, price=100.0):
    links = [("LG", f"S{i}", "", "FR", "Boulanger", f"https://b.com/ref/{i}#x", "true") for i in range(200)]
    links += [
        ("LG", "X", "E1", "NO", "Elkjop", "https://www.elkjop.no/product/100001", "true"),
        ("LG", "X", "E2", "NO", "Elkjop", "https://www.elkjop.no/product/100002", "true"),
        ("LG", "C1", "", "GB", "Currys", "https://www.currys.co.uk/products/c-10000001.html", "true"),
        ("LG", "C2", "", "GB", "Currys", "https://www.currys.co.uk/products/c-10000002.html", "true"),
        ("LG", "C3", "", "GB", "Currys", "https://www.currys.co.uk/products/c-10000003.html", "true"),
        ("LG", "A1", "", "DE", "Amazon", "https://www.amazon.de/dp/B000000001", "true"),
        ("LG", "N1", "", "DE", "Nowhere", "https://x", "true"),
        ("LG", "N2", "", "DE", "Currys", "https://y", "no"),
    ]
    meta = '<meta itemprop="price" content="%s"><meta itemprop="priceCurrency" content="%s">'
    pages = [
        ("https://www.elkjop.no/product/100002", 200, meta % ("4000", "NOK"), "TV"),
        ("https://www.currys.co.uk/products/c-10000001.html", 404, meta % ("500", "GBP"), "TV"),
        ("https://www.currys.co.uk/products/c-10000002.html", 200, "<p>no price</p>", "TV"),
        ("https://www.amazon.de/dp/B000000001", 200, meta % ("500", "GBP"), "TV"),
        ("https://www.currys.co.uk/products/c-10000003.html", 200, meta % ("500", "GBP"), "Just a moment..."),
    ]
    pages = spark.createDataFrame([(u, u, s, t, h, 1) for u, s, h, t in pages], "requested_url string, final_url string, http_status int, page_title string, html string, captured_at int")
    history = [log_row(i, "2026-08-01", f"S{i}", 100.0, platform="Boulanger")[:5] + ("FR",) + log_row(0, "", "", 100.0, platform="Boulanger")[6:] for i in range(200)]
    return monitor.Captured(
        links=spark.createDataFrame(links, "brand string, sku string, model string, country string, platform string, url string, active string"),
        history=spark.createDataFrame(history, LOG),
        snapshot=spark.createDataFrame([("boulanger", str(i), price + i % 2, "EUR") for i in range(190)], "channel string, batch_key string, price double, currency string"),
        api=spark.createDataFrame([("100001", 4990.0, "NOK", 2), ("100001", 3000.0, "NOK", 1), ("100002", None, None, 1)], "sku string, price double, currency string, captured_at int"),
        pages=pages,
    )


def stamp(results):
    return results.withColumns({"obs_date": F.lit("2026-08-05"), "obs_time": F.lit("05:00:00")})


def test_daily_monitor(spark, tmp_path):
    log = str(tmp_path / "log")
    summary = monitor.monitor(captured(spark), stamp, str(tmp_path / "staging"), log)
    assert {r.platform: (r.total, r.ok, r.batch_hits) for r in summary.collect()} == {
        "Boulanger": (200, 190, 190), "Elkjop": (2, 2, 0), "Currys": (3, 0, 0), "Amazon": (1, 0, 0), "Nowhere": (1, 0, 0),
    }
    rows = {r.product_name: r for r in spark.read.parquet(str(tmp_path / "staging")).collect()}
    assert (rows["S0"].trend, rows["S1"].trend, rows["S195"].trend) == ("FLAT", "UP", "-")
    assert {n: rows[n].status for n in ("S195", "E1", "E2", "C1", "C2", "C3", "A1", "N1")} == {
        "S195": "Failed: Navigation Error", "E1": "Success", "E2": "Success", "C1": "Failed: Dead Link",
        "C2": "Failed: Price Not Found", "C3": "Failed: Navigation Error", "A1": "Failed: Price Not Found", "N1": "Skipped: Unsupported Platform",
    }
    assert (rows["E1"].provenance, rows["E2"].provenance, rows["E1"].trend) == ("Direct API", "TV", "NEW")
    assert rows["E1"].price == 4990.0
    monitor.monitor(captured(spark), stamp, str(tmp_path / "again"), log)
    assert sinks.read_price_log(spark, log).count() == 192
    late = lambda rows: rows.withColumns({"obs_date": F.lit("2026-12-05"), "obs_time": F.lit("05:00:00")})
    monitor.monitor(captured(spark), late, str(tmp_path / "late"), log)
    assert {r.obs_date for r in sinks.read_price_log(spark, log).select("obs_date").distinct().collect()} == {"2026-12-05"}


def test_systematic_shift_voids_the_batch(spark):
    observed = monitor.observe(captured(spark, price=20.0), "boulanger")
    assert {r.status for r in observed.select("status").distinct().collect()} == {"Failed: Navigation Error"}


def test_api_catalogue_gates(spark):
    brands = ["Samsung", "LG", "Sony", "TCL", "Hisense", "iFfalcon"]

    def year_pages(year, base, **changes):
        hits = [hit(str(base + i), brand=brands[i % 6], attributes={"33627": [str(year)] if i % 2 else year, "31323": ["55"]}) for i in range(120)]
        for index, change in changes.items():
            hits[int(index[1:])].update(change)
        return [page(year, n, hits[n * 60:(n + 1) * 60], total=120, pages=2) for n in range(2)]

    def table(pages):
        return spark.createDataFrame(pages, "year int, page_index int, body string")

    good = year_pages(2025, 100000) + year_pages(2026, 200000)
    items = catalogue.api_items(table(good))
    assert items.count() == 240 and items.filter("source_brand = 'iFFALCON' AND brand_raw = 'TCL'").count() == 40
    bad = {
        "invalid_hit": year_pages(2025, 100000, h3={"brand": "Philips"}) + good[2:],
        "duplicate_sku": year_pages(2025, 100000, h3={"articleNumber": "100000", "productUrl": "/tv/100000"}) + good[2:],
        "page_drift": [page(2025, 0, json.loads(good[0][2])["results"][0]["hits"], total=119, pages=2)] + good[1:],
        "incomplete": good[:1] + good[2:],
        "cross_year_sku": good[:2] + year_pages(2026, 100100),
    }
    for name, pages in bad.items():
        with pytest.raises(catalogue.CatalogueRejected, match=name):
            catalogue.api_items(table(pages))


def test_market_items_and_lookups(spark):
    rows = [(0, "samsung", 1, i, f"b{i:09d}", "Samsung", f"Samsung {s} inch {c} TV 2026", "", "£500", False, True)
            for i, (s, c) in enumerate([(55, "S95H"), (65, "S95H"), (55, "QN90F"), (55, "Q7F")])]
    cards = spark.createDataFrame(rows, "query_no int, query string, page int, pos int, product_key string, brand string, title string, size_text string, price_text string, sponsored boolean, variant_hint boolean")
    items = catalogue.market_items(cards, "GBP")
    assert {(r.asin, r.series, r.price_local, r.fx_rate_date) for r in items.collect()} == {
        (f"B{i:09d}", s, 500.0, "2026-07-01") for i, s in enumerate(["S95H", "S95H", "QN90F", "Q7F"])
    }
    wanted = catalogue.lookups(items, items.filter("size = 65").withColumn("size", F.lit(75)))
    assert [r["query"] for r in wanted["rescue"].orderBy("pick_no").collect()] == ["samsung q7f", "samsung qn90f", "samsung s95h"]
    assert wanted["recovery"].count() == 1 and wanted["seeds"].count() == 4
    assert match.FAMILY == ["brand_key", "series"]
