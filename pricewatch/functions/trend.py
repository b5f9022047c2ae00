"""Price trend codes and their labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pricewatch.fixed_values import NO_TREND, TREND_LABELS


def trend_code(new_price: Column, old_price: Column) -> Column:
    return (
        F.when(new_price.isNull(), NO_TREND)
        .when(old_price.isNull(), "NEW")
        .when(new_price < old_price, "DOWN")
        .when(new_price > old_price, "UP")
        .otherwise("FLAT")
    )


def trend_label(code: Column) -> Column:
    (head, label), *rest = TREND_LABELS.items()
    return reduce(
        lambda w, cl: w.when(code == cl[0], cl[1]), rest, F.when(code == head, label)
    ).otherwise(NO_TREND)
