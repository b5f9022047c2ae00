"""Structured prices in captured HTML: meta tags, then JSON-LD offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewatch.functions.once import computed_once
from pricewatch.functions.price import schema_amount, with_schema_amount
from pricewatch.functions.text import blank_to_null, or_empty

_NODE = "offers string, `@graph` string"
_OFFER = "price string, priceCurrency string"
_LD_SCRIPT = r"(?is)<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"

_REFERENCES = (
    (r"(?i)&(?:nbsp|#0*160|#x0*a0);", "\u00a0"),
    (r"(?i)&(?:euro|#0*8364|#x0*20ac);", "€"),
    (r"(?i)&(?:pound|#0*163|#x0*a3);", "£"),
    (r"(?i)&(?:apos|#0*39|#x0*27);", "'"),
    (r"(?i)&(?:quot|#0*34|#x0*22);", '"'),
    (r"(?i)&(?:comma|#0*44|#x0*2c);", ","),
    (r"(?i)&(?:period|#0*46|#x0*2e);", "."),
    (r"(?i)&(?:amp|#0*38|#x0*26);", "&"),
)

# Meta tags by what they hold; the first named tag of a pair wins.
_AMOUNT_TAGS = (("property", "product:price:amount"), ("itemprop", "price"))
_CURRENCY_TAGS = (("property", "product:price:currency"), ("itemprop", "priceCurrency"))


def tag_text(html: Column, tag: str) -> Column:
    return or_empty(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1))


def without_comments(html: Column) -> Column:
    """The page without comments; what looks like one inside a script stays."""
    return F.regexp_replace(html, r"(?is)(<script\b.*?</script>)|<!--.*?(?:-->|\z)", "$1")


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<script\b.*?(?:</script>|\z)", "")


def meta_tag(html: Column, attribute: str, name: str) -> Column:
    """The first meta tag with the given attribute value, empty when there is none."""
    value = rf"(?:\"{name}\"|'{name}'|{name}(?=[\s/>]))"
    return F.regexp_extract(html, rf"(?is)<meta\b[^>]*(?<=[\s\"'/]){attribute}\s*=\s*{value}[^>]*>", 0)


def tag_content(tag: Column) -> Column:
    """The content attribute, quoted or not, with the usual character references decoded."""
    pattern = r"(?is)(?<=[\s\"'/])content\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return decoded(F.concat(*(F.regexp_extract(tag, pattern, group) for group in (1, 2, 3))))


def decoded(text: Column) -> Column:
    """Character references that occur in prices and currencies."""
    plain = text
    for pattern, character in _REFERENCES:
        plain = F.regexp_replace(plain, pattern, character)
    return F.when(text.contains("&"), plain).otherwise(text)


def with_meta_price(rows: DataFrame, html: Column, price: str, currency: str) -> DataFrame:
    """Add the price of the meta tags; a missing or echoed currency means EUR."""
    named = {f"__a{i}": tag for i, tag in enumerate(_AMOUNT_TAGS)}
    named |= {f"__c{i}": tag for i, tag in enumerate(_CURRENCY_TAGS)}
    tags = computed_once(rows, {c: meta_tag(html, *tag) for c, tag in named.items()})
    contents = computed_once(tags, {c: tag_content(F.col(c)) for c in named})
    amount = F.coalesce(blank_to_null(F.col("__a0")), blank_to_null(F.col("__a1")))
    stated = F.coalesce(blank_to_null(F.col("__c0")), blank_to_null(F.col("__c1")), F.lit("EUR"))
    found = computed_once(contents, {"__a0": amount, "__c0": stated})
    unit = F.when(F.col("__c0") == F.col("__a0"), "EUR").otherwise(F.col("__c0"))
    priced = with_schema_amount(found, F.col("__a0"), unit, price)
    return priced.withColumn(currency, F.when(F.col(price).isNotNull(), unit)).drop(*named)


def _elements(json: Column) -> Column:
    """Elements of a JSON list as texts; any other text is a list of itself."""
    return F.coalesce(F.from_json(json, "array<string>"), F.array(json))


def _filled(json: Column) -> Column:
    return F.when(~json.isin("", "{}", "[]"), json)


def _node_offers(node: Column) -> Column:
    """Offers of an item, else those of the first graph entry that has any."""
    graph = F.transform(_elements(node["@graph"]), lambda g: F.from_json(g, "offers string"))
    listed = F.filter(graph, lambda g: g["offers"].isNotNull())
    return F.coalesce(_filled(node["offers"]), F.get(listed, 0)["offers"])


def json_ld_offers(html: Column) -> Column:
    """``array<struct(price, priceCurrency)>`` over scripts and items, in document order."""
    scripts = F.filter(
        F.regexp_extract_all(html, F.lit(_LD_SCRIPT), F.lit(1)), lambda s: s.contains('"price"')
    )
    nodes = F.transform(F.flatten(F.transform(scripts, _elements)), lambda n: F.from_json(n, _NODE))
    offers = F.flatten(F.transform(nodes, lambda n: F.coalesce(_elements(_node_offers(n)), F.array())))
    return F.filter(
        F.transform(offers, lambda o: F.from_json(o, _OFFER)), lambda o: o["price"].isNotNull()
    )


def json_ld_price(html: Column) -> Column:
    """``struct(price, currency)`` of the first believable offer, null when there is none."""

    def priced(offer: Column) -> Column:
        unit = F.coalesce(offer["priceCurrency"], F.lit("EUR"))
        return F.struct(schema_amount(offer["price"], unit).alias("price"), unit.alias("currency"))

    prices = F.transform(json_ld_offers(html), priced)
    return F.get(F.filter(prices, lambda p: p["price"].isNotNull()), 0)


def with_structured_price(rows: DataFrame, html: Column, price: str = "price",
                          currency: str = "currency") -> DataFrame:
    """Add the structured price of each page: meta tags, else the first believable offer.

    Each page is searched where it lies: nothing is shuffled, and only pages without a
    meta price are searched for scripts.
    """
    page = F.col("__page")
    clean = computed_once(rows, {"__page": without_comments(html)})
    tags = computed_once(clean, {"__tags": without_scripts(page)})
    meta = with_meta_price(tags, F.col("__tags"), price, currency)
    found = computed_once(meta, {"__ld": F.when(F.col(price).isNull(), json_ld_price(page))})
    return found.withColumns(
        {
            price: F.coalesce(F.col(price), F.col("__ld.price")),
            currency: F.coalesce(F.col(currency), F.col("__ld.currency")),
        }
    ).drop("__ld", "__page", "__tags")
