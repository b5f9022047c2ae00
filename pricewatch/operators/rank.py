"""Fair, capped top-k picks.

Every pick first cuts each group to what can still be chosen. Spark turns the rank
filter into a per-task limit before the shuffle, so a group that holds a third of the
rows sends a few rows per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewatch.fixed_values import (
    RECOVERY_BUDGET,
    SEEDS_PER_FAMILY,
    SERIES_RESCUE_BUDGET,
    TARGET_BRANDS,
    VARIANT_SEED_BUDGET,
)
from pricewatch.functions import classify
from pricewatch.functions.text import or_empty
from pricewatch.operators.match import FAMILY
from pricewatch.operators.ordered import running_total
from pricewatch.operators.reconcile import family_sizes
from pricewatch.session import written


def brand_rank(brand: Column) -> Column:
    """Position in the target list; other brands follow, in alphabetical order."""
    return reduce(
        lambda w, ib: w.when(brand == ib[1], ib[0]),
        list(enumerate(TARGET_BRANDS))[1:],
        F.when(brand == TARGET_BRANDS[0], 0),
    ).otherwise(len(TARGET_BRANDS))


def with_seed_priority(items: DataFrame) -> DataFrame:
    """Add the four-part priority as one ascending number."""
    text = F.col("raw_text")
    parts = (
        F.coalesce(F.col("variant_hint"), F.lit(False)),
        classify.is_current_title(text),
        F.col("series") != "",
        F.col("price_local").isNotNull(),
    )
    score = reduce(lambda total, part: total * 2 + F.when(part, 0).otherwise(1), parts, F.lit(0))
    return items.withColumn("priority", score)


def family_cap(items: DataFrame, per_family: int = SEEDS_PER_FAMILY) -> DataFrame:
    """At most ``per_family`` items of a family by priority; items without a series all stay."""
    # Without a series every item is a family of its own, so no group collects them.
    loner = F.when(F.col("series") == "", F.col("pos"))
    window = Window.partitionBy(*FAMILY, loner).orderBy("priority", "pos")
    return (
        items.withColumn("__rank", F.row_number().over(window))
        .filter(F.col("__rank") <= per_family)
        .drop("__rank")
    )


def fair_pick(items: DataFrame, order: list, budget: int) -> DataFrame:
    """One item per brand in turn until the budget is spent; adds ``pick_no`` from 1."""
    turn = F.row_number().over(Window.partitionBy("brand_key").orderBy(*order))
    cut = items.withColumn("turn", turn).filter(F.col("turn") <= budget)
    # A turn holds one row of a brand at most. Turns are numbered each on its own, after the rows of
    # the turns before, so that no task sees all picks where the budget is large.
    cut = written(cut, "turns")
    turns = running_total(cut.groupBy("turn").agg(F.count("*").alias("__n")), [], "turn", "__n", "__so_far")
    before = turns.select("turn", (F.col("__so_far") - F.col("__n")).alias("__before"))
    in_turn = F.row_number().over(Window.partitionBy("turn").orderBy(brand_rank(F.col("brand_key")), "brand_key"))
    numbered = cut.join(before, "turn").withColumn("pick_no", (F.col("__before") + in_turn).cast("int"))
    return numbered.filter(F.col("pick_no") <= budget).drop("turn", "__before").orderBy("pick_no")


def variant_seeds(items: DataFrame, budget: int = VARIANT_SEED_BUDGET, per_family: int = SEEDS_PER_FAMILY) -> DataFrame:
    """Seeds for sibling look-ups: family cap, then a fair pick over brands."""
    return fair_pick(family_cap(with_seed_priority(items), per_family), ["priority", "pos"], budget)


def series_rescue(items: DataFrame, budget: int = SERIES_RESCUE_BUDGET) -> DataFrame:
    """Search texts for the series with the fewest sizes seen, brands in turn."""
    picked = fair_pick(family_sizes(items, FAMILY), ["sizes", "series"], budget)
    return picked.withColumn("query", F.lower(F.concat_ws(" ", "brand_key", "series")))


def recovery_pick(missing: DataFrame, budget: int = RECOVERY_BUDGET) -> DataFrame:
    """Missing sizes to look up again: 2026 first, wide families first, brands in turn."""
    width = family_sizes(missing, FAMILY).withColumnRenamed("sizes", "family_width")
    recent = classify.is_family_2026(F.col("brand_key"), F.col("series"), or_empty(F.col("raw_text")))
    rows = missing.join(width, FAMILY).withColumn("is_2026", recent)
    order = [F.col("is_2026").desc(), F.col("family_width").desc(), "series", "size", "pos"]
    return fair_pick(rows, order, budget)
