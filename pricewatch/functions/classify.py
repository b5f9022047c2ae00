"""Predicates and scores over titles, pages and responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pricewatch.fixed_values import (
    BLOCKED_CONTENT_MARKERS,
    BLOCKED_TITLE_MARKERS,
    CURRENT_SUFFIXES,
    DEAD_MARKERS,
    DEAD_MARKERS_BY_CHANNEL,
    GONE_STATUSES,
    RE_CURRENT_SERIES,
    RE_EXPLICIT_2026,
    RE_MODEL_LIKE,
    RE_NON_TV,
    RE_RATING,
    RE_REMOTE_ACCESSORY,
    RE_VARIANT_HINT,
    RE_YEAR,
    SPEC_PREFIXES,
)
from pricewatch.functions.identity import currys_key
from pricewatch.functions.text import contains_any, or_empty, starts_with_any


def is_non_tv(title: Column) -> Column:
    """Accessories and displays; remote controls only where sold as replacements."""
    text = or_empty(title)
    return text.rlike(RE_NON_TV) | text.rlike(RE_REMOTE_ACCESSORY)


def is_title_candidate(text: Column) -> Column:
    """Could this link text be a product name?"""
    t = or_empty(text)
    return (
        F.length(t).between(8, 200)
        & ~starts_with_any(F.lower(t), SPEC_PREFIXES)
        & ~t.rlike(RE_RATING)
        & F.upper(t).rlike(RE_MODEL_LIKE)
    )


def title_score(text: Column) -> Column:
    lowered = F.lower(text)
    return (
        F.when(lowered.startswith("tv "), 100).otherwise(0)
        + F.when(F.substring(lowered, 1, 10).contains("tv"), 30).otherwise(0)
        + F.when(F.length(text).between(25, 100), 20).otherwise(0)
    )


def is_dead_title(title: Column, channel: str | None = None) -> Column:
    return contains_any(
        F.lower(or_empty(title)), DEAD_MARKERS + DEAD_MARKERS_BY_CHANNEL.get(channel, ())
    )


def is_gone(status: Column, requested_url: Column, final_url: Column) -> Column:
    return status.isin(*GONE_STATUSES)


def is_gone_or_redirected(status: Column, requested_url: Column, final_url: Column) -> Column:
    """A product address that ended on a listing or on another product counts as gone."""
    requested, final = or_empty(requested_url), or_empty(final_url)
    return status.isin(*GONE_STATUSES) | (
        requested.contains("/products/")
        & (~final.contains("/products/") | (currys_key(final) != currys_key(requested)))
    )


def is_current_title(title: Column) -> Column:
    text = or_empty(title)
    return text.rlike(RE_YEAR) | text.rlike(RE_CURRENT_SERIES)


def is_variant_candidate(title: Column, variant_hint: Column) -> Column:
    """Worth looking up for sibling sizes."""
    return (
        F.coalesce(variant_hint, F.lit(False))
        | is_current_title(title)
        | or_empty(title).rlike(RE_VARIANT_HINT)
    )


def is_family_2026(brand: Column, series: Column, title: Column) -> Column:
    """The title says 2026, or the brand's series suffix does."""
    upper = F.upper(or_empty(brand))
    return reduce(
        lambda c, rule: c
        | ((upper == rule[0]) & reduce(lambda a, b: a | b, (series.endswith(s) for s in rule[1]))),
        CURRENT_SUFFIXES.items(),
        or_empty(title).rlike(RE_EXPLICIT_2026),
    )


def is_blocked_page(title: Column, content: Column) -> Column:
    return contains_any(F.lower(or_empty(title)), BLOCKED_TITLE_MARKERS) | contains_any(
        F.lower(or_empty(content)), BLOCKED_CONTENT_MARKERS
    )
