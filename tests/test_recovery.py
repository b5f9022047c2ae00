import random

import pytest
from pyspark.sql import functions as F

from pricewatch.operators import recovery
from pricewatch.plans.recovery import RecoveryRejected, recover

LINES = "run_id string, revision string, run_date string, line_no long, line string"
LOG = ("seq long, obs_date string, obs_time string, brand string, product_name string, country string, platform string, "
       "price double, currency string, provenance string, status string, trend string")


def product(model, platform="Currys"):
    return f"monitor\tSTEP\t2026-08-01T08:00:00.5Z → [GB] {model} ({platform})"


def price(amount):
    return f"2026-08-01T08:48:19.7964187Z   [ok/batch] GBP {amount} (持平)"


def unnamed(amount):
    return f"2026-08-03T08:48:19Z   [ok] GBP {amount} (持平)"


def log_of(spark, *runs):
    rows = [(f"r{n}", "head", f"2026-08-0{n}", i, line) for n, lines in enumerate(runs, 1) for i, line in enumerate(lines, 1)]
    return spark.createDataFrame(rows, LINES).repartition(3)


@pytest.mark.parametrize("block", [2, 1 << 16])
def test_pairing_rules(spark, block):
    lines = [
        product("A"), "noise", price("10.0"),
        product("B"), product("C (x)"), price("20.5"),
        product("D"), unnamed("5.0"), price("30.0"),
        price("40.0"),
        product("E", "Amazon"), price("50.0"),
        product("F") + " [ok/batch] GBP 1 (x)", price("60.0"),
    ]
    pairs = recovery.log_pairs(recovery.log_fields(log_of(spark, lines)), block).orderBy("line_no").collect()
    assert [(p.price, p.product_name, p.paired) for p in pairs] == [
        (10.0, "A", True), (20.5, "C (x)", True), (30.0, "D", True), (40.0, None, False), (50.0, None, False), (60.0, "F", True),
    ]
    excluded = recovery.excluded_lines(log_of(spark, lines)).collect()
    assert [(e.line_no, e.logged_at) for e in excluded] == [(8, "2026-08-03T08:48:19Z")]


@pytest.mark.parametrize("seed", range(3))
def test_pairing_matches_a_loop(spark, seed):
    rng = random.Random(seed)
    lines = [rng.choice([product(f"M{i}"), price(f"{i}.0"), unnamed("1.0"), "noise"]) for i in range(200)]
    pending, want = None, []
    for i, line in enumerate(lines):
        if "→" in line:
            pending = f"M{i}"
        elif "[ok/batch]" in line:
            want.append((float(i), pending))
            pending = None
    pairs = recovery.log_pairs(recovery.log_fields(log_of(spark, lines)), block=7).orderBy("line_no").collect()
    assert [(p.price, p.product_name) for p in pairs] == want


def test_recovery_on_a_written_log(spark, tmp_path):
    """Runs with textual ids and lines above 1000, against the log as the library writes it."""
    from pricewatch import sinks

    log = str(tmp_path / "log")
    sinks.write_log(spark.createDataFrame([log_row(1, "2026-07-31", "A", 100.0)], LOG), log, "daily")
    noise = ["noise"] * 1500
    runs = [("run-9", "2026-08-01", [*noise, product("A"), price("90.0")]), ("run-10", "2026-08-01", [product("A"), price("95.0")]),
            ("run-11", "2026-08-02", [product("A"), price("95.0")])]
    rows = [(run, "head", day, i, line) for run, day, lines in runs for i, line in enumerate(lines, 1)]
    mapping = spark.createDataFrame([("head", "A", "", "GB", "Currys", "LG", "true")], "revision string, sku string, model string, country string, platform string, brand string, active string")
    expected = spark.createDataFrame([(run, "Currys", 1) for run, _, _ in runs], "run_id string, platform string, expected long")
    found = recover(spark.createDataFrame(rows, LINES), mapping, expected, sinks.read_price_log(spark, log)).checked()
    assert {r.run_id: (r.old_price, r.trend) for r in found.rows.collect()} == {"run-9": (100.0, "DOWN"), "run-10": (100.0, "DOWN"), "run-11": (95.0, "FLAT")}
    assert sinks.append_recovered(sinks.read_price_log(spark, log), found.rows, log, "recovery", write=True)
    assert sinks.read_price_log(spark, log).count() == 4


def test_times(column_of):
    from pricewatch.functions.logs import line_timestamp, time_of

    assert column_of(line_timestamp, [price("1.0"), "none"]) == ["2026-08-01T08:48:19.7964187Z", ""]
    assert column_of(time_of, ["2026-08-01T08:48:19.7964187Z", "2026-08-01T08:48:20Z", ""]) == ["08:48:19", "08:48:20", "00:00:00"]


def log_row(seq, day, name, value, status="Success", platform="Currys", time="08:00:00"):
    return (seq, day, time, "LG", name, "GB", platform, value, "GBP", "t", status, "-")


def test_trends_compare_with_earlier_days(spark):
    existing = spark.createDataFrame([
        log_row(1, "2026-07-30", "A", 100.0), log_row(2, "2026-07-31", "A", 90.0), log_row(3, "2026-07-31", "A", 95.0, "Failed: x", time="09:00:00"),
        log_row(4, "2026-08-02", "B", 1.0), log_row(5, "2026-07-01", "C", 5.0, platform="Boulanger"),
    ], LOG)
    rows = spark.createDataFrame([
        log_row(1, "2026-08-01", "A", 90.0), log_row(2, "2026-08-01", "A", 80.0), log_row(3, "2026-08-03", "A", 85.0),
        log_row(4, "2026-08-02", "B", 7.0), log_row(5, "2026-08-02", "C", 7.0), log_row(6, "2026-08-04", "A", 85.0),
    ], LOG)
    got = recovery.recompute_trends(rows, existing).orderBy("seq").collect()
    assert [(r.old_price, r.trend) for r in got] == [
        (90.0, "FLAT"), (90.0, "DOWN"), (80.0, "UP"), (None, "NEW"), (None, "NEW"), (85.0, "FLAT"),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_trends_match_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [log_row(i, f"2026-08-{rng.randint(1, 9):02d}", rng.choice("AAAAB"), float(rng.randint(1, 4))) for i in range(150)]
    history, want = {}, {}
    for day in sorted({r[1] for r in rows}):
        today = [r for r in rows if r[1] == day]
        for r in today:
            old = history.get(r[4])
            want[r[0]] = "NEW" if old is None else "DOWN" if r[7] < old else "UP" if r[7] > old else "FLAT"
        history.update({r[4]: r[7] for r in today})
    got = recovery.recompute_trends(spark.createDataFrame(rows, LOG).repartition(4)).collect()
    assert {r.seq: r.trend for r in got} == want


def inputs(spark, **changes):
    lines = log_of(spark, [product("A"), price("10.0"), unnamed("3.0"), product("B", "Boulanger"), price("20.0")], [product("A"), price("9.0")])
    mapping = [("head", "LG", "A", "", "gb", "Currys", "true"), ("head", "TCL", "", "B", "GB", "Boulanger", "1")] + changes.get("mapping", [])
    expected = changes.get("expected", [("r1", "Currys", 1), ("r1", "Boulanger", 1), ("r2", "Currys", 1)])
    existing = [log_row(1, "2026-07-31", "A", 11.0)] + changes.get("existing", [])
    return (
        lines,
        spark.createDataFrame(mapping, "revision string, brand string, sku string, model string, country string, platform string, active string"),
        spark.createDataFrame(expected, "run_id string, platform string, expected long"),
        spark.createDataFrame(existing, LOG),
    )


@pytest.mark.parametrize("staged", [False, True])
def test_recovery_plan(spark, tmp_path, staged):
    done = recover(*inputs(spark), staging=str(tmp_path / "fields") if staged else None).checked()
    rows = done.rows.orderBy("run_id", "line_no").collect()
    assert [(r.brand, r.product_name, r.obs_date, r.obs_time, r.price, r.trend) for r in rows] == [
        ("LG", "A", "2026-08-01", "08:48:19", 10.0, "DOWN"), ("TCL", "B", "2026-08-01", "08:48:19", 20.0, "NEW"), ("LG", "A", "2026-08-02", "08:48:19", 9.0, "DOWN"),
    ]
    assert done.excluded.count() == 1


@pytest.mark.parametrize("name, changes", [
    ("ambiguous_brand", {"mapping": [("head", "Sony", "A", "", "gb", "Currys", "true")]}),
    ("unexpected_count", {"expected": [("r1", "Currys", 2), ("r1", "Boulanger", 1), ("r2", "Currys", 1)]}),
    ("unexpected_count", {"expected": [("r1", "Currys", 1), ("r1", "Boulanger", 1), ("r2", "Currys", 1), ("r3", "Currys", 1)]}),
    ("conflict", {"existing": [log_row(9, "2026-08-02", "Z", 1.0, platform="Boulanger")]}),
])
def test_recovery_is_rejected(spark, name, changes):
    with pytest.raises(RecoveryRejected, match=name):
        recover(*inputs(spark, **changes)).checked()


def test_other_platforms_do_not_conflict(spark):
    recover(*inputs(spark, existing=[log_row(9, "2026-08-02", "Z", 1.0, platform="Elkjop")])).checked()
    lines, *rest = inputs(spark)
    orphan = lines.withColumn("line", F.when(F.col("line").contains("→ [GB] B"), "x").otherwise(F.col("line")))
    with pytest.raises(RecoveryRejected, match="unpaired_price"):
        recover(orphan, *rest).checked()
