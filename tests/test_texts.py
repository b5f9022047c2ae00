"""Identity, attributes and classification of texts."""

from pyspark.sql import functions as F

from pricewatch.channels import batch_key
from pricewatch.functions import attributes as at
from pricewatch.functions import classify as cl
from pricewatch.functions import identity as ids
from pricewatch.functions.text import squeeze, strip, to_number


def test_batch_keys(column_of):
    rows = [
        ("Currys", "https://www.currys.co.uk/products/first-slug-44556677.html"),
        ("currys", "https://www.currys.co.uk/products/second-slug-44556677.html?from=list"),
        ("Boulanger", "https://www.boulanger.com/ref/7654321"),
        (" boulanger ", "https://www.boulanger.com/ref/7654321#top"),
        ("Currys", " https://www.currys.co.uk/all "),
        ("Elkjop", "https://www.elkjop.no/product/987654"),
        ("Nowhere", None),
    ]
    assert column_of(batch_key, rows, "p string, u string") == [
        "44556677", "44556677", "7654321", "7654321", "https://www.currys.co.uk/all",
        "https://www.elkjop.no/product/987654", "",
    ]


def test_other_ids(column_of):
    assert column_of(ids.elkjop_sku, ["/tv/12345?x", "/tv/1234", "/tv/123456789", "/1234567890"]) == [
        "12345", None, "123456789", None,
    ]
    assert column_of(ids.currys_slug, ["/products/samsung-1?x", "/tv"]) == ["samsung-1", None]
    assert column_of(ids.asin, [("b0abcdefgh", "x"), ("bad", "https://a/dp/b0abcdefgi/x"), ("", "x")], "a string, u string") == [
        "B0ABCDEFGH", "B0ABCDEFGI", None,
    ]


def test_canonical_urls(column_of):
    assert column_of(ids.elkjop_url, ["/product/tv/1/?a=1#b", "https://x.no/p//", "", "//cdn.no/x?q", "p/1"]) == [
        "https://www.elkjop.no/product/tv/1", "https://x.no/p", "https://www.elkjop.no", "https://cdn.no/x",
        "https://www.elkjop.no/p/1",
    ]
    assert column_of(ids.boulanger_url, ["/ref/1#avis", "https://b.com/ref/2?x=1#y"]) == [
        "https://www.boulanger.com/ref/1", "https://b.com/ref/2?x=1",
    ]


def test_series(column_of):
    rows = [
        ("Sony", "Big screen BRAVIA 5 from Sony"),
        ("Hisense", "Television Hisense 50E7S black"),
        ("Samsung", "A Samsung TQ77S90FAEXXC for the wall"),
        ("LG", "Offer: OLED83G5XYZ by LG"),
        ("TCL", "Kitchen set TCL 43P7K"),
        ("LG", "LG 50NU80ABC"),
        ("Samsung", "Samsung in plain M70H"),
        ("Sony", "Sony XR70 with 43 inches"),
        ("Philips", "Philips P7K"),
        ("LG", None),
    ]
    assert column_of(at.series_of, rows, "b string, t string") == [
        "BRAVIA5", "E7S", "S90F", "G5", "P7K", "NU80", "M70H", "XR70", "", "",
    ]


def test_brands(column_of):
    assert column_of(at.brand_by_substring, ["TV samsung 55", "bulgaria", "x", None]) == ["Samsung", "LG", "", ""]
    assert column_of(at.brand_by_word, ["TV SAMSUNG 55", "bulgaria", "LG-55", "Samsung LG"]) == ["Samsung", "", "LG", "Samsung"]
    assert column_of(at.brand_of_slug, ["samsung-s90f", "jvc-tv", "a4tech-x", "", "tcl"]) == ["Samsung", "JVC", "A4Tech", "", "TCL"]
    assert column_of(at.brand_elkjop, ["iFFALCON 55", "iffalcon", "LG tv", "x"]) == ["TCL", "TCL", "LG", ""]
    assert column_of(at.source_brand_elkjop, ["iFFALCON 55", "Sony"]) == ["iFFALCON", "Sony"]
    assert column_of(at.facet_source_brand, [" SAMSUNG ", "iffalcon", "Philips", None]) == ["Samsung", "iFFALCON", None, None]
    rows = [("Samsung", "LG tv"), ("NoName", "LG tv"), (" ", "LG tv"), (None, "x")]
    assert column_of(at.card_brand, rows, "b string, t string") == ["Samsung", "", "LG", ""]


def test_sizes(column_of):
    assert column_of(at.size_boulanger, ["TV 65 pouces", "TV 999 pouces 55\"", "TV 140 cm", "16 pouces", "139 CM"]) == [
        65.0, 55.0, 55.0, None, 55.0,
    ]
    assert column_of(at.size_amazon, ["55 Zoll", "65-inch", "75”", "43 pulgadas", "55", "7 inch"]) == [
        55.0, 65.0, 75.0, 43.0, None, None,
    ]
    rows = [("samsung-2025-65-oled-102", ""), ("tv-10", "TV 55-inch"), ("", "9\""), ("x-150-24", "")]
    assert column_of(at.size_currys, rows, "s string, t string") == [65.0, 55.0, None, 24.0]
    assert column_of(at.size_elkjop, ["TV 155\" x", "65 tommer", "1655 inch", "20\"", "121\""]) == [None, 65.0, None, None, None]


def test_small_readers(column_of):
    assert column_of(at.year_in, ["a 2026 b", "x2026", "2024", None]) == [2026, None, None, None]
    assert column_of(at.slug_title, ["samsung-s90f-65-qe65-102-20417733", "123-456", "", "a--b-1"]) == [
        "samsung s90f 65 qe65", "", "", "a b",
    ]
    got = column_of(at.listing_range, ["49–96 av 400 produkter", "1 - 48 AV 50 Produkter", "nothing"])
    assert [tuple(g) if g else None for g in got] == [(49, 96, 400), (1, 48, 50), None]
    rows = [("a", " a ", "b", " "), (None, "x", "x", "y z")]
    assert column_of(at.distinct_parts, rows, "a string, b string, c string, d string") == ["a b", "x y z"]
    rows = [("C6 TV", "LG"), ("lg C6", "LG"), ("C6", ""), ("", "LG"), ("C6", None)]
    assert column_of(at.title_with_brand, rows, "t string, b string") == ["LG C6 TV", "lg C6", "C6", "", "C6"]
    assert column_of(strip, ["  x \n"]) == ["x"]
    assert column_of(squeeze, [" a \n b "]) == ["a b"]
    assert column_of(to_number, ["1.5", " 1e2 ", "12d", "1_000", ".5", "", None]) == [1.5, 100.0, None, None, 0.5, None, None]


def test_accessories(column_of):
    rejected = [
        "Replacement remote for a TCL P7K television",
        "Set of 8 mounting screws M6 that fit an LG television",
        "Ladegerät 60 Watt passend zum Hisense Fernseher",
        "LADEGERÄT für TV",
        "Samsung Monitor 32",
    ]
    accepted = [
        "LG QNED85A 65 Zoll Fernseher, Magic Remote liegt bei",
        "TCL C8L 75 inch television with its remote control",
        "Monitoring TV",
    ]
    assert column_of(cl.is_non_tv, rejected + accepted) == [True] * 5 + [False] * 3


def test_gone_pages(column_of):
    product = "https://www.currys.co.uk/products/flat-screen-20417733.html"
    rows = [
        (200, product, "https://www.currys.co.uk/tv-and-audio/televisions/tvs"),
        (200, product, product),
        (200, product, "https://www.currys.co.uk/products/renamed-20417733.html?x"),
        (200, product, "https://www.currys.co.uk/products/renamed-20417734.html"),
        (404, product, product),
        (200, "https://www.currys.co.uk/tvs", "https://www.currys.co.uk/"),
    ]
    schema = "s int, r string, f string"
    assert column_of(cl.is_gone_or_redirected, rows, schema) == [True, False, False, True, True, False]
    assert column_of(cl.is_gone, rows, schema) == [False, False, False, False, True, False]
    assert column_of(lambda t: cl.is_dead_title(t, "boulanger"), ["ÉPUISÉ", "Page Not Found", "Fine", None]) == [True, True, False, False]
    assert column_of(lambda t: cl.is_dead_title(t, "currys"), ["épuisé", "Out of stock"]) == [False, True]


def test_titles(column_of):
    texts = ["TV SAMSUNG 55QN90F", "short", "Fréquence 100Hz native", "4,6/5 (16)", "Téléviseur sans modèle", "TV LG C6 OLED evo 4K 139 cm"]
    assert column_of(cl.is_title_candidate, texts) == [True, False, False, False, False, True]
    assert column_of(cl.title_score, ["TV LG C6 OLED evo 4K 139 cm", "Smart TV LG C6", "LG C6 OLED"]) == [150, 30, 0]
    rows = [("SAMSUNG", "S95H", "x"), ("SAMSUNG", "S95F", "x"), ("LG", "C6", None), ("SONY", "X", "TV 2026"), ("SONY", "X", "TV 20261")]
    assert column_of(cl.is_family_2026, rows, "b string, s string, t string") == [True, False, True, True, False]
    rows = [("Options: 3 sizes", False), ("TV", True), ("TV 2025", None), ("QE55S95H", None), ("TV", None)]
    assert column_of(cl.is_variant_candidate, rows, "t string, v boolean") == [True, True, True, True, False]
    rows = [("Just a Moment...", ""), ("x", "Verify you are HUMAN"), ("x", "y"), (None, None)]
    assert column_of(cl.is_blocked_page, rows, "t string, c string") == [True, True, False, False]
