"""Brand, size, year and series read from titles, slugs and attribute maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pricewatch.fixed_values import (
    AMAZON_BRANDS,
    BOULANGER_BRANDS,
    CURRYS_BRANDS,
    ELKJOP_BRANDS,
    FACET_BRANDS,
    RE_RANGE,
    RE_SIZE_AMAZON,
    RE_SIZE_CM,
    RE_SIZE_CURRYS,
    RE_SIZE_ELKJOP,
    RE_SIZE_POUCES,
    RE_SIZE_QUOTE,
    RE_YEAR,
    SERIES_PATTERNS,
    SIZE_ATTRIBUTE,
    YEAR_ATTRIBUTE,
)
from pricewatch.functions.price import within
from pricewatch.functions.text import (
    blank_to_null,
    first_group,
    first_of_patterns,
    or_empty,
    strip,
    to_number,
    without_spaces,
)


def first_of(*candidates: tuple[Column, str]) -> Column:
    """The value of the first true condition, else the empty string."""
    head, *rest = candidates
    return reduce(lambda w, c: w.when(*c), rest, F.when(*head)).otherwise("")


# --- brand -------------------------------------------------------------------------


def brand_by_substring(text: Column) -> Column:
    upper = F.upper(or_empty(text))
    return first_of(*((upper.contains(b.upper()), b) for b in BOULANGER_BRANDS))


def brand_by_word(text: Column, brands=AMAZON_BRANDS) -> Column:
    upper = F.upper(or_empty(text))
    return first_of(*((upper.rlike(rf"(?U)\b{b.upper()}\b"), b) for b in brands))


def brand_of_slug(slug: Column) -> Column:
    """Slug head in its usual spelling; an unknown head is title-cased."""
    head = F.lower(F.substring_index(or_empty(slug), "-", 1))
    known = [(head == b.lower(), b) for b in CURRYS_BRANDS]
    return reduce(lambda w, c: w.when(*c), known[1:], F.when(*known[0])).otherwise(_title_case(head))


def _title_case(word: Column) -> Column:
    """Capitalise every run of letters, also after a digit."""
    runs = F.regexp_extract_all(word, F.lit(r"(\p{L}+|\P{L}+)"))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def is_iffalcon(text: Column) -> Column:
    return or_empty(text).rlike(r"(?iU)\biF+ALCON\b")


def brand_elkjop(text: Column) -> Column:
    """The sub-brand iFFALCON is reported under TCL."""
    return F.when(is_iffalcon(text), "TCL").otherwise(brand_by_word(text, ELKJOP_BRANDS))


def source_brand_elkjop(text: Column) -> Column:
    return F.when(is_iffalcon(text), "iFFALCON").otherwise(brand_by_word(text, ELKJOP_BRANDS))


def facet_source_brand(brand: Column) -> Column:
    """Canonical spelling of a facet brand, null for any other brand."""
    lowered = F.lower(strip(or_empty(brand)))
    spelling = [(b.lower(), "iFFALCON" if b.lower() == "iffalcon" else b) for b in FACET_BRANDS]
    return reduce(
        lambda w, s: w.when(lowered == s[0], s[1]),
        spelling[1:],
        F.when(lowered == spelling[0][0], spelling[0][1]),
    )


def business_brand(source_brand: Column) -> Column:
    return F.when(F.lower(source_brand) == "iffalcon", "TCL").otherwise(source_brand)


def card_brand(brand: Column, title: Column) -> Column:
    """A card's own brand decides, even when unknown; only a blank one asks the title."""
    own = strip(or_empty(brand))
    return F.when(own != "", brand_by_word(own)).otherwise(brand_by_word(title))


# --- size --------------------------------------------------------------------------


def _matched_size(text: Column, pattern: str) -> Column:
    return first_group(text, pattern).try_cast("double")


def size_amazon(text: Column) -> Column:
    return _matched_size(or_empty(text), RE_SIZE_AMAZON)


def size_boulanger(text: Column) -> Column:
    """Inches in words, then a quote sign, then centimetres."""
    t = or_empty(text)
    return F.coalesce(
        within(_matched_size(t, RE_SIZE_POUCES), 17, 150),
        within(_matched_size(t, RE_SIZE_QUOTE), 17, 150),
        F.bround(within(_matched_size(t, RE_SIZE_CM) / 2.54, 17, 150)),
    )


def size_of_slug(slug: Column) -> Column:
    """First slug token that is a whole number from 24 to 120."""
    tokens = F.split(or_empty(slug), "-")
    sizes = F.filter(
        tokens,
        lambda t: t.rlike(r"^\d{2,3}$") & t.try_cast("int").between(24, 120),
    )
    return F.get(sizes, 0).try_cast("double")


def size_currys_title(text: Column) -> Column:
    return within(_matched_size(or_empty(text), RE_SIZE_CURRYS), 17, 150)


def size_currys(slug: Column, title: Column) -> Column:
    return F.coalesce(size_of_slug(slug), size_currys_title(title))


def size_elkjop(text: Column) -> Column:
    return within(_matched_size(or_empty(text), RE_SIZE_ELKJOP), 24, 120)


def facet_size(attributes: Column, title: Column) -> Column:
    """Numeric size attribute within range; the title only when the attribute is no number."""
    size = to_number(attribute_first(attributes, SIZE_ATTRIBUTE))
    return F.when(size.isNotNull(), within(size, 24, 120)).otherwise(size_elkjop(title))


# --- year and paging text ----------------------------------------------------------


def year_in(text: Column) -> Column:
    return first_group(or_empty(text), RE_YEAR).try_cast("int")


def model_year(text: Column, facet_year: Column) -> Column:
    return F.coalesce(year_in(text), facet_year)


def attribute_first(attributes: Column, key: str) -> Column:
    """An attribute's value, or the first of a list as JSON; null when the key or the list is missing."""
    value = F.try_element_at(attributes, F.lit(key))
    listed = F.get(F.from_json(value, "array<string>"), F.lit(0))
    return F.when(value.startswith("["), listed).otherwise(value)


def facet_year(attributes: Column) -> Column:
    return F.when(
        strip(attribute_first(attributes, YEAR_ATTRIBUTE)).rlike(r"^[+-]?\d+$"),
        strip(attribute_first(attributes, YEAR_ATTRIBUTE)).try_cast("int"),
    )


def listing_range(text: Column) -> Column:
    """``struct(first, last, total)`` of "a–b av n produkter"; null when absent."""
    t = or_empty(text)
    parts = [first_group(t, RE_RANGE, g).try_cast("int") for g in (1, 2, 3)]
    return F.when(
        parts[0].isNotNull(),
        F.struct(parts[0].alias("first"), parts[1].alias("last"), parts[2].alias("total")),
    )


def page_count(total: Column, page_size: int) -> Column:
    return F.ceil(total / page_size).cast("int")


# --- series ------------------------------------------------------------------------


def series_of(brand: Column, title: Column) -> Column:
    """Series code by ordered brand patterns, on the title and then on its letters run together."""
    text = or_empty(title)
    joined = without_spaces(text)
    upper_brand = F.upper(or_empty(brand))

    def matched(patterns) -> Column:
        return first_of_patterns((text, joined), patterns)

    (head, patterns), *rest = SERIES_PATTERNS.items()
    hit = reduce(
        lambda w, bp: w.when(upper_brand == bp[0], matched(bp[1])),
        rest,
        F.when(upper_brand == head, matched(patterns)),
    )
    return or_empty(without_spaces(F.upper(hit)))


# --- names -------------------------------------------------------------------------


def slug_title(slug: Column) -> Column:
    """Slug words without the closing number tokens."""
    words = F.array_join(F.filter(F.split(or_empty(slug), "-"), lambda t: t != ""), " ")
    return F.regexp_replace(words, r"(?:(?:^| )\d+)+$", "")


def distinct_parts(*parts: Column) -> Column:
    """Different non-blank parts in order, joined by a blank."""
    trimmed = F.transform(F.array(*parts), lambda p: strip(or_empty(p)))
    return F.array_join(F.array_distinct(F.filter(trimmed, lambda p: p != "")), " ")


def title_with_brand(title: Column, brand: Column) -> Column:
    """Prefix the card brand unless the title already starts with it."""
    own = blank_to_null(strip(or_empty(brand)))
    starts = F.lower(title).startswith(F.lower(own))
    return F.when(own.isNull() | starts | (title == ""), title).otherwise(
        F.concat(own, F.lit(" "), title)
    )
