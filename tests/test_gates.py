import random
import statistics

import pytest
from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.channels import gate_thresholds
from pricewatch.operators import gates, match, reconcile

LINKS = "brand string, product_name string, country string, platform string, url string"


def currys(first, count):
    return [("LG", f"M{i}", "GB", "Currys", f"https://www.currys.co.uk/products/tv-{first + i}.html?x") for i in range(count)]


def guard_inputs(spark, first, prices, olds, links=None):
    rows = currys(first, len(prices)) if links is None else links
    snapshot = [("currys", str(first + i), float(p), "GBP") for i, p in enumerate(prices)]
    latest = [(f"M{i}", "GB", "Currys", float(p)) for i, p in enumerate(olds)]
    return (
        spark.createDataFrame(rows, LINKS),
        spark.createDataFrame(snapshot, "channel string, batch_key string, price double, currency string"),
        spark.createDataFrame(latest, "product_name string, country string, platform string, old_price double"),
    )


@pytest.mark.parametrize("prices, olds, passed", [
    ([30] * 20, [600] * 20, False),
    ([950 + i for i in range(20)], [1000] * 20, True),
    ([30] * 19, [600] * 19, True),
    ([750] * 20, [1000] * 20, True),
    ([1350] * 20, [1000] * 20, True),
    ([1351] * 20, [1000] * 20, False),
    ([1000] * 19 + [399], [1000] * 20, True),
    ([1000] * 18 + [399, 2501], [1000] * 20, False),
    ([1000] * 18 + [400, 2500], [1000] * 20, True),
])
def test_drift_guard(spark, prices, olds, passed):
    verdict = gates.drift_guard(*guard_inputs(spark, 20400000, prices, olds)).first()
    assert (verdict.sample, verdict.passed) == (len(prices), passed)


def test_drift_guard_counts_links_not_keys(spark):
    links = currys(20400000, 1) * 20
    assert gates.drift_guard(*guard_inputs(spark, 20400000, [30], [600], links)).first().sample == 20


def test_drift_guard_skips_zero_prices(spark):
    assert gates.drift_guard(*guard_inputs(spark, 20400000, [30] * 3, [0, 600, 0])).first().sample == 1


@pytest.mark.parametrize("seed", range(4))
def test_median_is_exact(spark, seed):
    rng = random.Random(seed)
    groups = {
        "boulanger": [rng.choice([1.0, 1.0, 1.0, rng.random()]) for _ in range(rng.randint(1, 3000))],
        "currys": [rng.lognormvariate(0, 1) for _ in range(rng.randint(1, 3000))],
        "amazon": [float(rng.randint(1, 3)) for _ in range(rng.randint(1, 50))],
        "elkjop": [0.5] * rng.randint(1, 4),
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "channel string, ratio double").repartition(7)
    got = {r.channel: (r.median, r.n) for r in gates.median_and_counts(df, "channel", "ratio", n=F.count("*")).collect()}
    assert got == {k: (pytest.approx(statistics.median(v), rel=1e-15), len(v)) for k, v in groups.items()}


def test_coverage_gate_and_gated_snapshot(spark):
    links = [("LG", f"M{i}", "FR", "Boulanger", f"https://b/ref/{i}#a") for i in range(100)] * 2
    links += currys(10000000, 100)
    snapshot = [("boulanger", str(i), 100.0, "EUR") for i in range(50, 230)]
    snapshot += [("currys", str(10000000 + i), 100.0, "GBP") for i in range(300)]
    links = spark.createDataFrame(links, LINKS)
    snapshot = spark.createDataFrame(snapshot, "channel string, batch_key string, price double, currency string")
    gate = gates.coverage_gate(links, snapshot, gate_thresholds(spark))
    rows = {r.channel: (r["items"], r.requested, r.matched, r.coverage, r.passed) for r in gate.collect()}
    assert rows == {"boulanger": (180, 100, 50, 0.5, True), "currys": (300, 100, 100, 1.0, True)}
    drift = spark.createDataFrame([("currys", False)], "channel string, passed boolean")
    kept = gates.gated_snapshot(snapshot, gate, drift)
    assert [tuple(r) for r in kept.groupBy("channel").count().collect()] == [("boulanger", 180)]
    short = gates.coverage_gate(links, snapshot.filter("batch_key <> '50'"), gate_thresholds(spark))
    assert {r.channel: r.passed for r in short.collect()} == {"boulanger": False, "currys": True}
    empty = gates.coverage_gate(links.limit(0), snapshot, gate_thresholds(spark)).collect()
    assert [(r.coverage, r.passed) for r in empty] == [(0.0, False)] * 2


def test_canaries(spark):
    seen = [("DE", "B0GYZMPVXG", 115.0, "EUR"), ("DE", "B0GT9QKMRM", 400.0, "EUR"), ("GB", "B0F7WHLF6M", 149.0, "EUR"),
            ("IT", "B0GM1HFTNL", 238.5, "EUR"), ("IT", "XXXXXXXXXX", 159.0, "EUR")]
    observed = spark.createDataFrame(seen, "market string, asin string, price double, currency string")
    rows = match.canary_band(observed, schemas.canaries(spark), schemas.markets(spark)).collect()
    assert {r.market: (r.checked, r.passed) for r in rows} == {"DE": (2, True), "GB": (1, False), "IT": (1, True), "ES": (0, False)}


def test_completeness_checks(spark):
    pages = spark.createDataFrame([(2025, 0, 3, 1), (2025, 1, 3, 1), (2026, 0, 2, 1), (2026, 1, 3, 1)], "year int, page_index int, nb_hits int, nb_pages int")
    hits = spark.createDataFrame([(2025, "1"), (2025, "2"), (2025, "3"), (2026, "3"), (2026, "4"), (2026, "4")], "year int, sku string")
    done = {r.year: (r.found, r.complete) for r in reconcile.completeness(pages, hits, minimum=2).collect()}
    assert done == {2025: (3, True), 2026: (2, False)}
    assert {r.year: r.complete for r in reconcile.completeness(pages, hits).collect()} == {2025: False, 2026: False}
    assert {r.year: r.stable for r in reconcile.page_drift(pages).collect()} == {2025: True, 2026: False}
    assert [tuple(r) for r in reconcile.duplicate_skus(hits).collect()] == [(2026, "4", 2)]
    assert [tuple(r) for r in reconcile.cross_year_skus(hits).collect()] == [("3", [2025, 2026])]
    ranges = spark.createDataFrame([(2025, 1, "1–3 av 6 produkter"), (2025, 2, "4–6 av 6 produkter"), (2025, 3, "?")], "year int, page int, range_text string")
    cards = spark.createDataFrame([(2025, 1)] * 3 + [(2025, 2)] * 2, "year int, page int")
    checked = {r.page: (r.expected, r.cards, r.consistent) for r in reconcile.page_range_check(ranges, cards).collect()}
    assert checked == {1: (3, 3, True), 2: (3, 2, False), 3: (None, 0, True)}


def test_digest_ignores_order_and_sees_changes(spark):
    rows = [("2026-08-01", "Currys", i, f"M{i}") for i in range(50)]
    schema = "obs_date string, platform string, n int, name string"
    a = reconcile.manifest_counts(spark.createDataFrame(rows, schema), ["n", "name"]).first()
    b = reconcile.manifest_counts(spark.createDataFrame(rows[::-1], schema).repartition(5), ["n", "name"]).first()
    c = reconcile.manifest_counts(spark.createDataFrame(rows[:-1] + [("2026-08-01", "Currys", 49, "x")], schema), ["n", "name"]).first()
    assert a == b and a.digest != c.digest and a.recovered_rows == 50


def test_gates_fail_closed(spark):
    snapshot = spark.createDataFrame([("currys", "1", 1.0, "GBP"), ("boulanger", "2", 2.0, "EUR"), ("amazon", "3", 3.0, "EUR")], "channel string, batch_key string, price double, currency string")
    coverage = spark.createDataFrame([("currys", True), ("boulanger", True), ("amazon", None)], "channel string, passed boolean")
    drift = spark.createDataFrame([("currys", None)], "channel string, passed boolean")
    assert [r.channel for r in gates.gated_snapshot(snapshot, coverage, drift).collect()] == ["boulanger"]
    ratios = spark.createDataFrame([("currys", None)] * 30 + [("boulanger", 1.0)] * 25 + [("boulanger", None)] * 30, "channel string, ratio double")
    got = {r.channel: (r.sample, r.median_ratio, r.passed) for r in gates.drift_verdict(ratios).collect()}
    assert got == {"currys": (0, None, True), "boulanger": (25, 1.0, True)}
