"""Price text, schema amounts, currency rules and conversion to EUR."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricewatch.fixed_values import (
    CURRENCY_TOKENS,
    MIN_SCHEMA_PRICE,
    RE_KRONER,
    RE_NUMBER,
    UNITS_PER_EUR,
)
from pricewatch.functions.once import computed_once
from pricewatch.functions.text import blank_to_null, or_empty, strip, to_number


def currency_of(text: Column) -> Column:
    """Pound first, then dollar, then krone; euro when nothing says otherwise."""
    return (
        F.when(text.contains("£") | text.contains("GBP"), "GBP")
        .when(text.contains("$") | text.contains("USD"), "USD")
        .when(F.upper(text).contains("NOK") | text.rlike(RE_KRONER), "NOK")
        .otherwise("EUR")
    )


def _first_number(text: Column) -> Column:
    return F.regexp_extract(text, RE_NUMBER, 0).try_cast("double")


def _bare_amount(text: Column) -> Column:
    """The text without currency signs and blanks."""
    bare = reduce(lambda c, token: F.replace(c, F.lit(token), F.lit("")), CURRENCY_TOKENS, text)
    return F.replace(strip(bare), F.lit(" "), F.lit(""))


def _plain_number(bare: Column, currency: Column) -> Column:
    """The first number of a bare amount, its separators read by currency.

    Euro and krone amounts with both separators use the dot for thousands. A krone
    amount whose last dot is followed by exactly three characters has a thousands dot;
    a lone euro dot stays a decimal point. Pound and dollar commas are thousands.
    """
    dotted, commaed = bare.contains("."), bare.contains(",")
    return _first_number(
        F.when(currency.isin("GBP", "USD"), F.translate(bare, ",", ""))
        .when(dotted & commaed, F.translate(bare, ",.", "."))
        .when(
            (currency == "NOK") & dotted,
            F.regexp_replace(bare, r"(?s)^(.*)\.([^.]{3})\z", "$1$2"),
        )
        .otherwise(F.translate(bare, ",", "."))
    )


def price_from_text(text: Column) -> Column:
    """``with_price`` as one expression, for the elements of a short array."""
    currency = currency_of(text)
    number = _plain_number(_bare_amount(text), currency)
    return F.struct(number.alias("price"), F.when(number.isNotNull(), currency).alias("currency"))


def schema_amount(amount: Column, currency: Column) -> Column:
    """``with_schema_amount`` as one expression, for the elements of a short array."""
    text, code = strip(amount), F.upper(currency)
    symbol = F.when(code == "GBP", "£").when(code == "USD", "$").otherwise("")
    value = F.coalesce(to_number(text), price_from_text(F.concat(symbol, text)).getField("price"))
    return F.when(value >= MIN_SCHEMA_PRICE, value)


def with_price(rows: DataFrame, text: Column, price: str = "price", currency: str = "currency") -> DataFrame:
    """Add the first amount of a text and its currency; both are null when there is none.

    Built in steps, so that each text is cleaned once and the generated code stays small.
    """
    texts = computed_once(rows, {"__text": text})
    cleaned = computed_once(
        texts, {"__currency": currency_of(F.col("__text")), "__bare": _bare_amount(F.col("__text"))}
    )
    read = computed_once(cleaned, {price: _plain_number(F.col("__bare"), F.col("__currency"))})
    return read.withColumn(
        currency, F.when(F.col(price).isNotNull(), F.col("__currency"))
    ).drop("__text", "__currency", "__bare")


def with_schema_amount(rows: DataFrame, amount: Column, currency: Column, price: str = "price") -> DataFrame:
    """Add a machine-readable amount, else one read as price text; below 10 is not believed."""
    code = F.upper(currency)
    symbol = F.when(code == "GBP", "£").when(code == "USD", "$").otherwise("")
    texts = computed_once(rows, {"__amount": strip(amount), "__symbol": symbol})
    plain = computed_once(texts, {"__plain": to_number(F.col("__amount"))})
    unread = F.when(F.col("__plain").isNull(), F.concat("__symbol", "__amount"))
    read = with_price(plain, unread, "__read", "__unit")
    value = F.coalesce("__plain", "__read")
    return computed_once(read, {price: F.when(value >= MIN_SCHEMA_PRICE, value)}).drop(
        "__amount", "__symbol", "__plain", "__read", "__unit"
    )


def with_market_price(rows: DataFrame, text: Column, expected: Column) -> DataFrame:
    """Add ``price_local``, ``currency`` and ``price_eur``.

    A price in another currency than the market's keeps its code but not its amount.
    """
    read = with_price(computed_once(rows, {"__expected": expected}), text, "__price", "currency")
    matches = F.col("currency") == F.col("__expected")
    local = F.when(matches, F.round("__price", 2))
    eur = F.when(matches, to_eur(F.col("__price"), F.col("currency")))
    return read.select(
        *(c for c in read.columns if c not in ("__price", "__expected", "currency", "price_local", "price_eur")),
        local.alias("price_local"),
        or_empty(F.col("currency")).alias("currency"),
        eur.alias("price_eur"),
    )


def within(value: Column, low: float, high: float) -> Column:
    """The value when it lies in the closed range, else null."""
    return F.when(value.between(low, high), value)


def comma_decimal_amount(text: Column) -> Column:
    """French card text: comma is the decimal sign, there is no thousands rule."""
    cleaned = text
    for token in ("\xa0", "€", "EUR", " "):
        cleaned = F.replace(cleaned, F.lit(token), F.lit(""))
    return _first_number(F.translate(cleaned, ",", "."))


def pound_amount(text: Column) -> Column:
    """British card text: commas are thousands."""
    return _first_number(F.translate(text, "£,", ""))


def as_kroner(text: Column) -> Column:
    """Norwegian card text: the unit is known, so it is added before reading."""
    return F.concat(blank_to_null(text), F.lit(" NOK"))


def to_eur(price: Column, currency: Column) -> Column:
    """Convert by the fixed reference rates; an unknown currency gives null."""
    code = F.upper(strip(or_empty(currency)))
    return reduce(
        lambda branches, rate: branches.when(code == rate[0], _in_eur(price, rate[1])),
        list(UNITS_PER_EUR.items())[1:],
        F.when(code == "EUR", _in_eur(price, UNITS_PER_EUR["EUR"])),
    )


def _in_eur(price: Column, units: str) -> Column:
    return eur_at_rate(price, F.lit(units).cast("decimal(10,6)"))


def eur_at_rate(price: Column, units_per_eur: Column) -> Column:
    """Decimal division, rounded half up to cents."""
    amount = price.try_cast("decimal(20,6)")
    return F.round(F.try_divide(amount, units_per_eur), 2).cast("double")
