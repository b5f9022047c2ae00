"""Small text helpers shared by the column functions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from pricewatch.fixed_values import RE_FLOAT, WHITESPACE


def strip(text: Column) -> Column:
    """Trim every Unicode space, not only the blank."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def without_spaces(text: Column) -> Column:
    return F.translate(text, WHITESPACE, "")


def squeeze(text: Column) -> Column:
    """Trim, and turn each run of white space into one blank."""
    return F.regexp_replace(strip(text), r"(?U)\s+", " ")


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null when nothing matches."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def first_of_patterns(texts, patterns, group: int = 1) -> Column:
    """The group of the first pattern that matches; every pattern tries the first text first.

    A failing pattern costs one search, and nothing after the first hit is tried.
    """
    (text, pattern), *rest = [(t, p) for t in texts for p in patterns]
    return reduce(
        lambda w, tp: w.when(tp[0].rlike(tp[1]), F.regexp_extract(tp[0], tp[1], group)),
        rest,
        F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group)),
    )


def contains_any(text: Column, words) -> Column:
    return reduce(or_, (text.contains(word) for word in words))


def starts_with_any(text: Column, words) -> Column:
    return reduce(or_, (text.startswith(word) for word in words))


def to_number(text: Column) -> Column:
    """Cast only plain decimal or exponent notation; anything else is null."""
    trimmed = strip(text)
    return F.when(trimmed.rlike(RE_FLOAT), trimmed.try_cast("double"))
