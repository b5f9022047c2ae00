"""First and last row per key, as map-side combined aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewatch.functions.once import computed_once
from pricewatch.functions.text import squeeze


def _pick(rows: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    carried = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(pick(F.struct(*order, *carried)).alias("__row"))
    return best.select(*keys, "__row.*")


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(rows, keys, order, F.min)


def last_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(rows, keys, order, F.max)


def distinct_texts(rows: DataFrame, text: str, order: list[str], keep: list[str] | None = None) -> DataFrame:
    """First row of each text, ignoring case and runs of white space; blank texts go.

    Whole texts are compared by their SHA-256, so only the digest is a shuffle key. The
    result has the ``order`` columns and those to ``keep``, by default all; a long text
    that is not kept is not shuffled either.
    """
    carried = [c for c in (rows.columns if keep is None else keep) if c not in order]
    normal = computed_once(rows, {"__normal": F.lower(squeeze(F.col(text)))})
    keyed = normal.filter(F.col("__normal") != "").select(
        F.sha2("__normal", 256).alias("__digest"), *order, *carried
    )
    return first_seen(keyed, ["__digest"], order).drop("__digest")
