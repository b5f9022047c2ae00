import json
import os
import random

import pytest
from pyspark.sql import functions as F

from pricewatch.fixed_values import PRICE_LOG_CSV_HEADER
from pricewatch.functions.markup import with_structured_price
from pricewatch.sources import api, captures, catalogue, links, price_log, run_logs


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_links_from_csv(spark, tmp_path):
    path = write(tmp_path / "links.csv", "﻿" + "\n".join([
        "brand,sku,model,country,platform,url,active",
        " LG ,S1,M1,,Boulanger, http://a ,TRUE",
        "LG,,M2,gb,Currys,http://b,1",
        "LG,S3,M3,no,Elkjop,http://c,yes",
        "LG,S4,M4,fr,Boulanger,,true",
        "LG,S5,M5,fr,Boulanger,http://e,",
        "LG,S6,M6,fr,Boulanger,http://f,false",
        '"L ""G""",S7,M7,de,Amazon,http://g,true',
    ]) + "\n")
    raw = links.read_links(spark, path)
    rows = [tuple(r) for r in links.active_links(raw).orderBy("url").collect()]
    assert rows == [
        ("LG", "S1", "FR", "Boulanger", "http://a"),
        ("LG", "M2", "GB", "Currys", "http://b"),
        ("LG", "M3", "NO", "Elkjop", "http://c"),
        ('L "G"', "S7", "DE", "Amazon", "http://g"),
    ]
    audit = links.links_audit(raw).first()
    assert (audit.total_rows, audit.active_rows, audit.active_without_url, audit.usable_rows, audit.usable_ok) == (7, 5, 1, 4, True)


def test_links_without_active_column(spark, tmp_path):
    path = write(tmp_path / "links.csv", "brand,model,country,platform,url\nLG,M1,fr,Boulanger,\n")
    raw = links.read_links(spark, path)
    audit = links.links_audit(raw).first()
    assert (audit.active_rows, audit.usable_rows, audit.usable_ok) == (1, 0, False)


def test_brand_map(spark):
    rows = [
        ("h", "LG", "S1", "M1", "gb", "Currys", "true"), ("h", "TCL", "S1", "M1", "GB", "Currys", "true"),
        ("h", "Sony", "", "M2", "", "Elkjop", "true"), ("h", "X", "S9", "", "gb", "Currys", "no"),
        ("g", "LG", "S1", "M1", "gb", "Currys", "true"),
    ]
    raw = spark.createDataFrame(rows, "revision string, brand string, sku string, model string, country string, platform string, active string")
    got = {(r.revision, r.product_name, r.country, r.platform): (r.brand, r.brands) for r in links.brand_map(raw).collect()}
    assert got == {
        ("h", "S1", "GB", "Currys"): ("LG", 2), ("h", "M2", "", "Elkjop"): ("Sony", 1), ("g", "S1", "GB", "Currys"): ("LG", 1),
    }


def test_price_csvs_newest_file_wins(spark, tmp_path):
    header = "Date,Time,Brand,Product Name,Country,Platform,Price,Currency,Page Title,Status,Price_Trend\n"
    new = write(tmp_path / "prices.csv", "﻿" + header + "\n".join([
        "2026-08-01,08:00:00,LG,A,FR,Boulanger,900,EUR,t,Success,-",
        "2026-08-01,09:00:00,LG,A,FR,Boulanger,910.5,EUR,t,Success,-",
        '2026-08-01,10:00:00,LG,A,FR,Boulanger,,EUR,"a, ""b""",Success,-',
        "2026-08-01,11:00:00,LG,A,FR,Boulanger,950,EUR,t,Failed: Dead Link,-",
        "2026-08-01,11:00:00,LG,B,FR,Boulanger,oops,EUR,t,Success,-",
    ]) + "\n")
    old = write(tmp_path / "prices_2026.csv", header + "\n".join([
        "2026-09-01,08:00:00,LG,A,FR,Boulanger,1,EUR,t,Success,-",
        "2026-09-01,08:00:00,LG,C,FR,Boulanger,7,EUR,t,Success,-",
    ]) + "\n")
    os.utime(old, (1_700_000_000, 1_700_000_000))
    os.utime(new, (1_800_000_000, 1_800_000_000))
    log = price_log.read_price_csvs(spark, str(tmp_path / "prices*.csv"))
    latest = price_log.latest_prices(price_log.price_history(log))
    assert {r.product_name: r.old_price for r in latest.collect()} == {"A": 910.5, "C": 7.0}


@pytest.mark.parametrize("split_bytes", ["200", "1000", "1000000"])
def test_log_files_are_numbered_across_splits(spark, tmp_path, split_bytes):
    wanted = {}
    for run in ("r1", "r2", "r3"):
        lines = [f"{run} line {i} {'x' * random.Random(i).randint(0, 30)}" for i in range(1, 90)]
        lines[3] = ""
        write(tmp_path / f"{run}.log", "\n".join(lines) + "\n")
        wanted[run] = lines
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = run_logs.read_log_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {}
    for row in rows:
        got.setdefault(row.run_id, {})[row.line_no] = row.line
    assert {run: [lines[i] for i in sorted(lines)] for run, lines in got.items()} == wanted
    assert all(sorted(lines) == list(range(1, 90)) for lines in got.values())


def test_log_lines(spark):
    logs = spark.createDataFrame([("a", "x\r\ny\n\nz\n"), ("b", "")], "run_id string, body string")
    assert [tuple(r) for r in run_logs.log_lines(logs).orderBy("line_no").collect()] == [
        ("a", 1, "x"), ("a", 2, "y"), ("a", 3, ""), ("a", 4, "z"),
    ]


def hit(sku, **changes):
    base = {
        "articleNumber": sku, "brand": "Samsung", "title": 'Samsung 55" TV', "name": 'Samsung 55" TV',
        "manufacturerArticleNumber": "QE55", "productUrl": f"/product/tv/{sku}?q", "urlB2C": "/x",
        "price": {"amount": 4990.0, "currency": "NOK"},
        "attributes": {"33627": ["2025"], "31323": ["55"]}, "shortDescription": " nice ",
    }
    return {**base, **changes}


def page(year, index, hits, total=None, pages=1):
    body = {"results": [{"nbHits": len(hits) if total is None else total, "nbPages": pages, "hits": hits}]}
    return (year, index, json.dumps(body))


def test_search_responses(spark):
    hits = [
        hit("100001"),
        hit(None, objectID="100002", brand="iffalcon", attributes={"31323": ["big"]}, price={"amount": None, "currency": "NOK"}),
        hit("100003", attributes={"33627": ["x"], "31323": ["500"]}, productUrl="", urlB2C="https://www.elkjop.no/product/100003/"),
    ]
    responses = spark.createDataFrame([page(2025, 0, hits), page(2025, 1, [])], "year int, page_index int, body string")
    rows = api.api_hits(responses).orderBy("pos").collect()
    assert [(r.sku, r.source_brand, r.facet_year, r.size_hint_inch, r.url) for r in rows] == [
        ("100001", "Samsung", 2025, 55.0, "https://www.elkjop.no/product/tv/100001"),
        ("100002", "iFFALCON", None, 55.0, "https://www.elkjop.no/product/tv/None"),
        ("100003", "Samsung", None, None, "https://www.elkjop.no/product/100003"),
    ]
    assert rows[0].raw_text == 'Samsung 55" TV QE55 nice'
    items = api.hit_items(api.api_hits(responses)).orderBy("elkjop_sku").collect()
    assert [(i.brand_raw, i.price_local, i.price_eur) for i in items][:2] == [("Samsung", 4990.0, 441.1), ("TCL", None, None)]
    pages = api.api_pages(responses).orderBy("page_index").collect()
    assert [(p.nb_hits, p.nb_pages, p.page_hits) for p in pages] == [(3, 1, 3), (0, 1, 0)]


def test_price_responses(spark):
    def body(price, currency="NOK", **sellability):
        return json.dumps([{"result": {"data": {"price": {"currency": currency, "current": price}, "sellability": sellability}}}])

    rows = [
        ("1", body([4990.0, 3992.0])), ("2", body([99])), ("3", body([4990], "SEK")), ("4", body([4990], isDisabled=True)),
        ("5", body([4990], isDiscontinued=True)), ("6", body([])), ("7", "not json"), ("8", body(["5000"], "nok")), ("9", "[]"),
    ]
    got = api.api_prices(spark.createDataFrame(rows, "sku string, body string")).orderBy("sku").collect()
    assert [r.price for r in got] == [4990.0, None, None, None, None, None, None, 5000.0, None]
    assert [r.currency for r in got] == ["NOK" if p else None for p in [r.price for r in got]]


LD = '<script type="application/ld+json">%s</script>'


@pytest.mark.parametrize("html, want", [
    ('<meta property="product:price:amount" content="499.5"><meta property="product:price:currency" content="GBP">', (499.5, "GBP")),
    ("<META content='1499' itemprop='price'><meta itemprop='priceCurrency' content='1499'>", (1499.0, "EUR")),
    ('<meta property="product:price:amount" content=""><meta itemprop="price" content="20">', (20.0, "EUR")),
    ('<meta itemprop="price" content="5">' + LD % '{"offers":{"price":"77"}}', (77.0, "EUR")),
    (LD % '{broken "price"' + LD % '[1,{"offers":["x",{"price":"3"},{"price":88,"priceCurrency":"NOK"}]}]', (88.0, "NOK")),
    (LD % '{"offers":[],"@graph":[7,{"offers":{"price":66}}]}', (66.0, "EUR")),
    (LD % '[{"a":1},{"offers":[{"price":"3"},{"price":88,"priceCurrency":"NOK"}]}]', (88.0, "NOK")),
    (LD % '{"@graph":[{"@type":"x"},{"offers":{"price":"1,299","priceCurrency":"GBP"}}]}', (1299.0, "GBP")),
    (LD % '{"offers":{"lowPrice":"50"}}', None),
    ("<p>price 99</p>", None),
    (None, None),
])
def test_structured_price(spark, html, want):
    df = spark.createDataFrame([(html,)], "html string")
    row = with_structured_price(df, F.col("html")).first()
    got = None if row.price is None else (row.price, row.currency)
    assert got == want


def test_blocked_pages_hold_no_price(spark):
    html = '<meta itemprop="price" content="499">'
    rows = [("Just a moment...", html), ("TV", html + "verify you are human"), ("TV", html)]
    pages = spark.createDataFrame(rows, "page_title string, html string")
    assert [r.page_price for r in captures.page_prices(pages).collect()] == [None, None, 499.0]


def test_recent_snapshots(spark):
    rows = [
        ("DE", f"2026-08-{day:02d}", 1, "b1", "Samsung TV S95H", "Samsung", float(50 + day)) for day in range(1, 11)
    ] + [
        ("DE", "2026-08-01", 2, "b2", "Samsung TV S95H", "Samsung", 55.0),
        ("DE", "2026-08-10", 3, "b3", "Samsung TV", "Samsung", 55.0),
        ("DE", "2026-08-10", 4, "b4", "Samsung TV S95H", "Samsung", 0.0),
        ("DE", "2026-08-10", 5, "b1", "Samsung TV S95H", "Samsung", 99.0),
        ("GB", "2026-07-01", 1, "b5", "LG OLED55C6", "LG", 55.0),
    ]
    items = spark.createDataFrame(rows, "country string, snapshot_date string, pos int, asin string, raw_text string, brand_raw string, size_hint_inch double")
    got = {(r.country, r.asin): r.size_hint_inch for r in catalogue.recent_snapshots(items).collect()}
    assert got == {("DE", "B1"): 99.0, ("GB", "B5"): 55.0}


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    from pricewatch.sources.links import active_links, read_links
    from pricewatch.sources.price_log import read_price_csvs

    header = list(PRICE_LOG_CSV_HEADER.values())
    ours = list(PRICE_LOG_CSV_HEADER)
    cells = {c: c for c in ours} | {"price": "1.5", "currency": "GBP"}
    other = [c for c in reversed(header) if c != PRICE_LOG_CSV_HEADER["trend"]]
    back = {theirs: mine for mine, theirs in PRICE_LOG_CSV_HEADER.items()}
    (tmp_path / "a.csv").write_text("\ufeff" + ",".join(header) + "\n" + ",".join(cells[c] for c in ours) + "\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(",".join(other) + "\n" + ",".join(cells[back[c]] for c in other) + "\n", encoding="utf-8")
    got = read_price_csvs(spark, str(tmp_path / "*.csv")).select(*ours).collect()
    assert sorted((r.price, r.currency, r.product_name, r.trend or "") for r in got) == [("1.5", "GBP", "product_name", ""), ("1.5", "GBP", "product_name", "trend")]
    (tmp_path / "links").mkdir()
    (tmp_path / "links" / "l.csv").write_text('\ufeffurl,brand,sku,model,platform\nhttps://x,LG,"A\n""B""",M,Currys\n', encoding="utf-8")
    assert [(r.product_name, r.country, r.url) for r in active_links(read_links(spark, str(tmp_path / "links"))).collect()] == [('A\n"B"', "FR", "https://x")]
