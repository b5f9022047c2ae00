"""Catalogue routes and follow-up, the pages of a daily run, and CSV files across splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from test_jobs import captured
from test_sources import hit, page

from pricewatch.channels import gate_thresholds
from pricewatch.operators import gates, match, reconcile
from pricewatch.plans import catalogue, monitor
from pricewatch.sources.api import api_hits, api_pages
from pricewatch.sources.csv_files import csv_records, read_csv_by_header
from pricewatch.sources.links import active_links


def test_only_pages_of_unpriced_links_are_parsed(spark):
    run = captured(spark)
    old = run.pages.withColumns({"captured_at": F.lit(0), "html": F.lit("<p>old</p>")})
    read = run.pages.limit(1).withColumn("requested_url", F.lit("https://b.com/ref/1#x"))  # priced by the batch
    never = run.pages.limit(1).withColumn("requested_url", F.lit("https://not-in-the-list"))
    undated = run.pages.limit(1).withColumns({"requested_url": F.lit("https://b.com/ref/195#x"), "captured_at": F.lit(None).cast("int")})
    pages = run.pages.union(old).union(read).union(never).union(undated)
    links = active_links(run.links)
    coverage = gates.coverage_gate(links, run.snapshot, gate_thresholds(spark))
    offers = match.offered(links, gates.gated_snapshot(run.snapshot, coverage, spark.createDataFrame([], "channel string, passed boolean")), run.api)
    chosen = monitor.pages_to_read(offers, pages).select("requested_url", "captured_at").collect()
    wanted = [r.url for r in match.unpriced(offers).collect()]
    assert len(wanted) == 10 + 1 + 3 + 1  # listed without a price: Boulanger, Elkjop, Currys, Amazon
    assert sorted(r.requested_url for r in chosen) == sorted([r.requested_url for r in run.pages.collect()] + ["https://b.com/ref/195#x"])
    assert {r.captured_at for r in chosen} == {1, None}


PRODUCTS = {2025: range(100000, 100100), 2026: range(200000, 200060)}


def listing(spark, skip=(), lost=()):
    cards, ranges = [], []
    for year, skus in PRODUCTS.items():
        for i, sku in enumerate(skus):
            no = i // 48 + 1
            if (year, no) in skip or sku in lost:
                continue
            text = "" if sku % 10 == 3 else "Samsung" if sku % 2 else "LG"
            cards.append((year, no, 2 * i, str(sku), f"/product/tv/{sku}?x", f'{text} 55" TV', "fine picture", ""))
            cards.append((year, no, 2 * i + 1, str(sku), f"/product/tv/{sku}", f'{text} 55" TV', "", "" if sku % 7 == 0 else "4990.-"))
        for no in range(1, (len(skus) - 1) // 48 + 2):
            if (year, no) not in skip:
                ranges.append((year, no, f"{48 * no - 47}–{min(48 * no, len(skus))} av {len(skus)} produkter"))
    return catalogue.Listing(
        spark.createDataFrame(cards, "year int, page int, pos int, product_key string, href string, title string, text string, price_text string"),
        spark.createDataFrame(ranges, "year int, page int, range_text string"),
        spark.createDataFrame([(str(s), 1000.0 + s, "NOK") for s in PRODUCTS[2025]], "product_key string, price double, currency string"),
    )


def test_elkjop_takes_the_listing_when_the_api_fails(spark):
    broken = spark.createDataFrame([page(2025, 0, [hit("1")], total=7, pages=1)], "year int, page_index int, body string")
    rows = {r.elkjop_sku: r for r in catalogue.elkjop_rows(broken, listing(spark)).collect()}
    named = [s for skus in PRODUCTS.values() for s in skus if s % 10 != 3]
    assert sorted(map(int, rows)) == named
    assert rows["100004"].price_local == 4990.0
    assert rows["100004"].url == "https://www.elkjop.no/product/tv/100004" and rows["100004"].size_hint_inch == 55.0
    assert rows["100009"].brand_raw == "Samsung" and rows["200001"].model_year == 2026
    from_detail = next(s for s in PRODUCTS[2025] if s % 7 == 0 and s % 10 != 3)
    assert rows[str(from_detail)].price_local == 1000.0 + from_detail
    with pytest.raises(catalogue.CatalogueRejected):
        catalogue.elkjop_rows(broken)
    for bad in (listing(spark, skip=[(2025, 2)]), listing(spark, lost=[100005]), listing(spark, skip=[(2026, 1), (2026, 2)])):
        with pytest.raises(catalogue.CatalogueRejected, match="listing"):
            catalogue.elkjop_rows(broken, bad)


def test_api_gates_agree_with_the_single_checks(spark):
    draw = random.Random(4)
    brands = ["Samsung", "LG", "Sony", "Philips"]
    pages = []
    for year in (2025, 2026):
        hits = [hit(str(draw.choice([1, 1, 2]) * 100000 + draw.randrange(300)), brand=draw.choice(brands),
                    attributes={"33627": [str(draw.choice([year, year, 2024]))], "31323": ["55"]}) for _ in range(150)]
        pages += [page(year, n, hits[n * 50 : n * 50 + 50], total=150 + (n == 2), pages=3) for n in range(3)]
    responses = spark.createDataFrame(pages, "year int, page_index int, body string")
    declared, found = api_pages(responses), api_hits(responses)
    got = {r.gate: r.violations for r in reconcile.api_gates(declared, found).collect()}
    assert got == {
        "page_drift": 2,
        "invalid_hit": reconcile.invalid_hits(found).count(),
        "duplicate_sku": reconcile.duplicate_skus(found).count(),
        "incomplete": reconcile.completeness(declared, found).where("NOT complete").count(),
        "cross_year_sku": reconcile.cross_year_skus(found).count(),
        "missing_brand": 2,
    }
    assert list(got) == list(reconcile.API_GATES)
    nothing = {r.gate: r.violations for r in reconcile.api_gates(declared.limit(0), found.limit(0)).collect()}
    assert nothing == {"page_drift": 0, "invalid_hit": 0, "duplicate_sku": 0, "incomplete": 2, "cross_year_sku": 0, "missing_brand": 5}


CARDS = "query_no int, query string, page int, pos int, product_key string, brand string, title string, size_text string, price_text string, sponsored boolean, variant_hint boolean"


def cards(spark, *rows):
    return spark.createDataFrame([(0, q, 1, i, a, "Samsung", t, "", "£500", False, hint) for i, (q, a, t, hint) in enumerate(rows)], CARDS)


def test_follow_up_goes_on_until_nothing_is_new(spark):
    first = cards(spark, ("samsung", "B000000001", "Samsung 55 inch S95H TV", False), ("samsung", "B000000002", "Samsung 43 inch Plain TV", False))
    searches = cards(
        spark,
        ("samsung s95h", "B000000001", "Samsung 55 inch S95H TV", False),  # held
        ("samsung s95h", "B000000003", "Samsung 65 inch S95H TV", True),
        ("samsung qn90f", "B000000009", "Samsung 75 inch QN90F TV", False),
        ("samsung q7f", "B000000010", "Samsung 75 inch Q7F TV", False),  # never asked for
    )
    ref = "array<struct<asin: string, text: string>>"
    details = spark.createDataFrame(
        [
            ("B000000003", "Samsung 65 inch S95H TV", "£1", [("b000000004", ""), ("B000000005", "77 inch"), ("B000000006", "")]),
            ("B000000004", "Samsung 77 inch S95H TV 2026", "£2", [("B000000007", "")]),
            ("B000000005", "Wandhalterung für Samsung TV 77 Zoll", "£3", None),
            ("B000000007", "Samsung 83 inch QN90F TV 2026", "£4", [("B000000001", ""), ("B000000003", "")]),
            ("H000000001", "Samsung 97 inch S95H TV", "£5", None),
            ("H000000002", "Samsung without a size", "£6", None),
        ],
        f"asin string, title string, price_text string, refs {ref}",
    )
    history = catalogue.market_items(
        cards(spark, ("x", "H000000001", "Samsung 97 inch S95H TV", False), ("x", "H000000002", "Samsung 98 inch S95H TV", False),
              ("x", "H000000003", "Samsung 65 inch S95H TV", False), ("x", "H000000004", "Samsung 100 inch S95H TV", False)), "GBP")
    found = catalogue.LookedUp(searches, details)

    def asins(rounds, budgets=catalogue.Budgets()):
        rows = catalogue.amazon_rows(first, "GB", found=found, history=history, budgets=budgets, rounds=rounds)
        return sorted(int(r.asin[1:]) + 100 * (r.asin[0] == "H") for r in rows.collect())

    assert asins(1) == [1, 2, 3, 4, 101]
    assert asins(2) == [1, 2, 3, 4, 7, 101]
    assert asins(None) == [1, 2, 3, 4, 7, 9, 101]
    one = catalogue.Budgets(rescue=1, recovery=1, seeds=1, per_family=1)
    assert asins(None, one) == [1, 2, 3, 4, 7, 9, 101]
    assert sorted(r.asin for r in catalogue.amazon_rows(first, "GB").collect()) == ["B000000001", "B000000002"]


def test_cards_are_dealt_to_many_tasks_and_read_once(spark, monkeypatch):
    read = {}

    def noted(rows, name, written=catalogue.written):
        read.setdefault(name, rows.inputFiles())
        return written(rows, name)

    monkeypatch.setattr(catalogue, "written", noted)
    shown = cards(spark, *(("samsung", f"B{i:09d}", "Samsung 55 inch S95H TV", False) for i in range(80)))
    items = catalogue.amazon_rows(shown.coalesce(1), "GB")
    assert items.count() == 80
    assert len(read["read-cards"]) > 1 and all("/market-cards-" in f for f in read["read-cards"])
    assert items.inputFiles() and all("/read-cards-" in f for f in items.inputFiles())


def test_text_rules_read_the_wanted_details_only(spark):
    wanted = spark.createDataFrame([("A", 1, "LG")], "asin string, pos int, brand_raw string")
    titles = [("A", "LG 55 inch C6 TV", "£1"), ("B", "LG 65 inch C6 TV", "£2")]
    details = spark.createDataFrame(titles, "asin string, title string, price_text string")
    items = catalogue._detail_items(wanted, details, "GBP")
    assert [(r.asin, r.size) for r in items.collect()] == [("A", 55)]
    optimised = items._jdf.queryExecution().optimizedPlan().toString()
    below = optimised[optimised.index("Join Inner"):]
    assert "RLIKE" in optimised and "RLIKE" not in below and "regexp" not in below


@pytest.mark.parametrize(("split_bytes", "block"), [("64", 5), ("1000", 1 << 16), ("1000000", 3)])
def test_csv_records_across_splits(spark, tmp_path, split_bytes, block):
    draw = random.Random(1)
    wanted = []
    for name in ("a", "b"):
        columns = ["n", "text", "more"] if name == "a" else ["more", "n"]
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\r\n" if name == "a" else "\n")
        writer.writerow(columns)
        for i in range(60):
            row = {"n": f"{name}{i}", "text": draw.choice(["x", 'q "u"', "a,b", "l\nm\n\nn", '"\n"', ""]), "more": draw.choice(["é\nz", "", "last,"])}
            writer.writerow([row[c] for c in columns])
            wanted.append((row["n"], (row["text"] or None) if name == "a" else None, row["more"] or None))
        (tmp_path / f"{name}.csv").write_bytes(("﻿" + out.getvalue()).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        assert csv_records(spark, str(tmp_path), block).groupBy("file").agg(F.max("record_no")).collect()[0][1] == 61
        rows = [(r.n, r.text, r.more) for r in read_csv_by_header(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(rows) == sorted(wanted)
