"""Rankings, families and cards against plain loops on small fixtures."""

import random

import pytest

from pricewatch.fixed_values import TARGET_BRANDS
from pricewatch.operators import cards as card_ops
from pricewatch.operators import dedup, match, ordered, paging, rank

ITEM = "pos int, asin string, brand_raw string, raw_text string, size_hint_inch double, variant_hint boolean, price_local double"


def samsung(pos, size, code="S95H", hint=True):
    return (pos, f"B{pos}", "Samsung", f"Samsung QE{size}{code}ATXXU OLED TV 2026", float(size), hint, 1.0)


def items_of(spark, rows):
    return match.family_columns(spark.createDataFrame(rows, ITEM))


def test_two_seeds_per_family(spark):
    items = items_of(spark, [samsung(i, s) for i, s in enumerate((48, 55, 65, 77))])
    assert [r.asin for r in rank.variant_seeds(items).collect()] == ["B0", "B1"]


def test_rescue_prefers_few_sizes(spark):
    items = items_of(spark, [samsung(1, 55), samsung(2, 55, "QN90F"), samsung(3, 65, "QN90F")])
    assert [r["query"] for r in rank.series_rescue(items).orderBy("pick_no").collect()] == ["samsung s95h", "samsung qn90f"]


def test_only_missing_sizes_are_recovered(spark):
    history = items_of(spark, [samsung(1, 48), samsung(2, 55), samsung(3, 65), samsung(2, 55)])
    today = items_of(spark, [samsung(1, 48)])
    missing = match.missing_sizes(history, today)
    assert sorted(r["size"] for r in missing.collect()) == [55, 65]
    assert sorted(r["size"] for r in rank.recovery_pick(missing).collect()) == [55, 65]


def round_robin(rows, key, budget):
    """Rows sorted by key, one per brand in turn."""
    queues = {}
    for row in sorted(rows, key=key):
        queues.setdefault(row["brand_key"], []).append(row)
    order = [*TARGET_BRANDS, *sorted(set(queues) - set(TARGET_BRANDS))]
    picked = []
    while len(picked) < budget and any(queues.get(b) for b in order):
        for brand in order:
            if queues.get(brand) and len(picked) < budget:
                picked.append(queues[brand].pop(0))
    return picked


@pytest.mark.parametrize("seed", range(4))
def test_seeds_match_a_loop(spark, seed):
    rng = random.Random(seed)
    brands = ["SAMSUNG", "LG", "TCL", "ZETA", "ALPHA"]
    weights = [10, 3, 3, 1, 1]
    rows = [
        {"pos": i, "brand_key": rng.choices(brands, weights)[0], "series": rng.choice(["", "A", "B", "C"]),
         "raw_text": rng.choice(["TV 2026", "TV"]), "variant_hint": rng.random() < 0.5,
         "price_local": rng.choice([None, 1.0])}
        for i in range(rng.randint(5, 120))
    ]
    df = spark.createDataFrame(
        [tuple(r.values()) for r in rows],
        "pos int, brand_key string, series string, raw_text string, variant_hint boolean, price_local double",
    )

    def priority(row):
        return (not row["variant_hint"], "2026" not in row["raw_text"], not row["series"], row["price_local"] is None, row["pos"])

    kept, used = [], {}
    for row in sorted(rows, key=priority):
        family = (row["brand_key"], row["series"])
        used[family] = used.get(family, 0) + 1
        if not row["series"] or used[family] <= 2:
            kept.append(row)
    want = [r["pos"] for r in round_robin(kept, priority, 40)]
    got = [r.pos for r in rank.variant_seeds(df.repartition(4)).orderBy("pick_no").collect()]
    assert got == want
    few = rank.variant_seeds(df, budget=7).orderBy("pick_no").collect()
    assert [r.pos for r in few] == want[:7]


def test_large_budgets_are_numbered_by_many_tasks(spark):
    rows = [(i, f"b{i % 3}" if i % 7 else None, i // 2) for i in range(300)]
    df = spark.createDataFrame(rows, "pos int, brand_key string, cost int").repartition(4)
    picked = rank.fair_pick(df, ["cost", "pos"], 1_000_000)
    assert "TakeOrdered" not in picked._jdf.queryExecution().executedPlan().toString()
    groups = [sorted((r[2], r[0]) for r in rows if r[1] == b) for b in (None, "b0", "b1", "b2")]
    want = [g[turn][1] for turn in range(300) for g in groups if turn < len(g)]
    assert [(r.pos, r.pick_no) for r in picked.collect()] == [(pos, n) for n, pos in enumerate(want, 1)]
    assert [r.pos for r in rank.fair_pick(df, ["cost", "pos"], 10).collect()] == want[:10]


CARD = ("query_no int, query string, page int, pos int, product_key string, brand string, title string, size_text string, "
        "sponsored boolean, variant_hint boolean")


@pytest.mark.parametrize("seed", range(3))
def test_card_reasons_match_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.randint(0, 2), "q", rng.randint(1, 3), i, rng.choice(["", "b1", "B2", "b3", "B4"]),
         rng.choice(["", "LG", "NoName"]), rng.choice(["", "LG 55 inch TV", "LG TV", "LG 55 inch wall mount", "TV 55\""]),
         rng.choice(["", "55 inches"]), rng.random() < 0.2, False)
        for i in range(80)
    ]
    held, want = set(), {}
    for row in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        _, _, _, pos, key, brand, title, size_text, sponsored, _ = row
        asin = key.upper()
        named = brand == "LG" or (not brand and "LG" in title)
        sized = "55" in title or size_text
        if sponsored:
            want[pos] = "sponsored"
        elif asin in held:
            want[pos] = "duplicate"
        elif not asin or not title:
            want[pos] = "blank"
        elif not named:
            want[pos] = "no_brand"
        elif not sized:
            want[pos] = "no_size"
        elif "wall mount" in title:
            want[pos] = "non_tv"
        else:
            want[pos] = None
            held.add(asin)
    reasons = card_ops.card_reasons(spark.createDataFrame(rows, CARD).repartition(3))
    assert {r.pos: r.reason for r in reasons.collect()} == want
    counts = card_ops.filter_reasons(reasons).collect()
    assert sum(r.cards for r in counts) == 80 and sum(r.kept for r in counts) == len(held)


@pytest.mark.parametrize("seed", range(3))
def test_longest_card_matches_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), i, f"/{i}", "t", "x" * rng.randint(1, 4), rng.choice(["", "", f"{i} kr"])) for i in range(rng.randint(1, 25))]
    want = {}
    for key, pos, _, _, text, price in rows:
        held = want.get(key)
        if held is None or len(text) > len(held[1]):
            want[key] = [pos, text, price]
        elif price and not held[2]:
            held[2] = price
    df = spark.createDataFrame(rows, "k string, pos int, href string, title string, text string, price_text string")
    got = {r.k: [r.pos, r.text, r.price_text] for r in card_ops.merge_longest_card(df.repartition(3), ["k"]).collect()}
    assert got == want


def test_merge_links(spark):
    rows = [("a", 1, "/1", "", ""), ("a", 2, "/2", "TV one", "£5"), ("a", 3, "/3", "TV two", "£6"), ("b", 4, "/4", None, None)]
    df = spark.createDataFrame(rows, "k string, pos int, href string, title string, price_text string")
    got = {r.k: (r.title, r.price_text, r.href) for r in card_ops.merge_links(df, ["k"]).collect()}
    assert got == {"a": ("TV one", "£5", "/1"), "b": ("", "", "/4")}


def test_listing_items(spark):
    links = [
        (1, "/ref/1#avis", "4,6/5 (16)", ""), (2, "/ref/1", "TV SAMSUNG 55QN90F 139 cm Neo", "1 299,00 €"),
        (3, "https://www.boulanger.com/ref/1", "Smart TV SAMSUNG 55QN90F", "999,00 €"), (4, "/ref/2", "nameless", "5 €"),
    ]
    df = spark.createDataFrame(links, "pos int, href string, text string, price_text string")
    assert [tuple(r) for r in card_ops.boulanger_items(df).collect()] == [
        ("Samsung", "TV SAMSUNG 55QN90F 139 cm Neo", "https://www.boulanger.com/ref/1", 55.0, 999.0),
    ]
    cards = spark.createDataFrame([("lg-c5-oled-55-oled55c5-1028", "/products/x?y", "LG TV", "£1,299.00")], "product_key string, href string, title string, price_text string")
    assert [tuple(r) for r in card_ops.currys_items(cards).collect()] == [
        ("LG", "lg c5 oled 55 oled55c5", "https://www.currys.co.uk/products/x", 55.0, 1299.0),
    ]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_do_not_show(spark, block):
    rng = random.Random(block)
    rows = [(k, i, rng.randint(0, 9)) for k in "ab" for i in sorted(rng.sample(range(60), 30))]
    df = spark.createDataFrame(rows, "k string, i long, v int").repartition(5)
    before, total, want = {}, {}, []
    for k, i, v in rows:
        total[k] = total.get(k, 0) + v
        want.append((k, i, before.get(k), total[k]))
        before[k] = v
    got = ordered.previous_row(df, ["k"], "i", ["v"], "prev", block)
    got = ordered.running_total(got, ["k"], "i", "v", "total", block)
    assert sorted((r.k, r.i, r.prev.v if r.prev else None, r.total) for r in got.collect()) == sorted(want, key=lambda w: w[:2])


def test_paging(spark):
    cards = [("q", p, k) for p, keys in enumerate(["ab", "bc", "c", "a", "d"], 1) for k in keys]
    seen = spark.createDataFrame(cards, "query string, page int, product_key string")
    pages = seen.select("query", "page").distinct()
    novelty = paging.page_novelty(seen, pages)
    assert [tuple(r) for r in novelty.select("page", "new_items", "total_items").orderBy("page").collect()] == [
        (1, 2, 2), (2, 1, 3), (3, 0, 3), (4, 0, 3), (5, 1, 4),
    ]
    single, double = paging.stop_page_single(novelty), paging.stop_page_double(novelty)
    assert (single.first().stop_page, double.first().stop_page) == (3, 4)
    assert paging.before_stop(seen, single).count() == 5
    assert paging.first_pages(pages, 2).count() == 2


def test_first_last_and_text_dedup(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert {r.k: r.v for r in dedup.first_seen(df, ["k"], ["o"]).collect()} == {"a": "y", "b": "z"}
    assert {r.k: r.v for r in dedup.last_seen(df, ["k"], ["o"]).collect()} == {"a": "x", "b": "z"}
    texts = spark.createDataFrame([(1, " LG  TV "), (2, "lg tv"), (3, "  "), (4, None), (5, "lg tv x")], "i int, t string")
    assert sorted(r.i for r in dedup.distinct_texts(texts, "t", ["i"]).collect()) == [1, 5]


def test_variant_expand(spark):
    seeds = spark.createDataFrame(
        [(1, "Samsung", [("b2", "55 inch"), ("B1", ""), ("", ""), ("B3", "65 inch"), ("B9", "")]), (2, "LG", [("B2", "43 inch"), ("B4", "75 inch")])],
        "seed_pos int, brand_raw string, refs array<struct<asin:string,text:string>>",
    )
    held = spark.createDataFrame([("B1",)], "asin string")
    details = spark.createDataFrame(
        [("B1", "x 55 inch", ""), ("B2", "TV", "£9"), ("B3", "Sony wall mount 65 inch", ""), ("B4", "Sony TV", ""), ("B9", "LG 48 inch", "")],
        "asin string, title string, price_text string",
    )
    got = {r.asin: (r.brand_raw, r.size_hint_inch, r.price_text) for r in match.variant_expand(seeds, held, details, per_seed=4).collect()}
    assert got == {"B2": ("Samsung", 55.0, "£9"), "B4": ("Sony", 75.0, "")}


def test_seen_and_missing_prices(spark):
    held = spark.createDataFrame([("A", False), ("B", True)], "asin string, variant_hint boolean")
    found = spark.createDataFrame([("A", True), ("A", False), ("C", True)], "asin string, variant_hint boolean")
    assert [r.asin for r in match.unseen(found, held).collect()] == ["C"]
    assert {r.asin: r.variant_hint for r in match.flag_seen(found, held).collect()} == {"A": True, "B": True}
    cards = spark.createDataFrame(
        [("1", "LG TV 2026", "", "", 2025), ("2", "LG TV", "", "4 990.-", 2025), ("3", "LG TV", "", "", 2024), ("4", "x", "", "", 2025)],
        "product_key string, title string, text string, price_text string, filter_year int",
    )
    details = spark.createDataFrame([(k, 5000.0, "NOK") for k in "1234"], "product_key string, price double, currency string")
    got = {r.product_key: r.price_local for r in match.fill_missing_price(cards, details).collect()}
    assert got == {"1": 5000.0, "2": 4990.0, "3": None, "4": None}
