"""Data-quality gates as verdict tables: nothing is collected to decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewatch.fixed_values import (
    GUARD_EXTREME,
    GUARD_EXTREME_SHARE,
    GUARD_MEDIAN,
    GUARD_MIN_SAMPLE,
)
from pricewatch.operators.match import BATCH_KEY, guard_rows, requested_keys
from pricewatch.session import written

#: Bins of a value unit, coarse and fine; values beyond the limit share the outer bins.
_COARSE, _FINE, _LIMIT = 1 << 8, 1 << 20, 1_000_000


def _extreme(ratio: Column) -> Column:
    return (ratio < GUARD_EXTREME[0]) | (ratio > GUARD_EXTREME[1])


def _bin(value: Column, per_unit: int) -> Column:
    return F.floor(F.greatest(F.least(value, F.lit(_LIMIT)), F.lit(-_LIMIT)) * per_unit)


def median_and_counts(rows: DataFrame, key: str, value: str, **counts: Column) -> DataFrame:
    """Exact interpolated median per group with further counts, for few but huge groups.

    ``counts`` are counting aggregates, which add up. The rows are read once: distinct
    values with their counts, and the coarse and the fine bin they fall in, are written.
    The bins that hold the two middle ranks are then found level by level, so no task
    orders more than the bins of a group or the values of one fine bin. Nulls do not
    count, and a group without a value has a null median.
    """
    counted = (
        rows.groupBy(key, F.col(value).alias("__value"))
        .agg(F.count(value).alias("__rows"), *(expression.alias(name) for name, expression in counts.items()))
        .withColumns({"__coarse": _bin(F.col("__value"), _COARSE), "__fine": _bin(F.col("__value"), _FINE)})
    )
    counted = written(counted, "counted-values")
    summary = counted.groupBy(key).agg(F.sum("__rows").alias("__n"), *(F.sum(name).alias(name) for name in counts))
    middle = F.array(F.floor((F.col("__n") + 1) / 2), F.floor(F.col("__n") / 2) + 1)
    # Two rows a group: the rank looked for inside what has been found so far.
    found = summary.where("__n > 0").select(key, F.posexplode(middle).alias("__which", "__rank"))
    inside = [key]
    for level in ("__coarse", "__fine", "__value"):
        totals = (
            counted.where(F.col("__value").isNotNull())
            .join(F.broadcast(found), inside)
            .groupBy(*inside, "__which", "__rank", level)
            .agg(F.sum("__rows").alias("__rows"))
        )
        upto = Window.partitionBy(key, "__which").orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = totals.withColumn("__through", F.sum("__rows").over(upto))
        before = F.col("__through") - F.col("__rows")
        inside = [*inside, level]
        found = ranked.where((before < F.col("__rank")) & (F.col("__rank") <= F.col("__through"))).select(
            *inside, "__which", (F.col("__rank") - before).alias("__rank")
        )
    medians = found.groupBy(key).agg((F.sum("__value") / 2).alias("median"))
    return summary.select(key, *counts).join(medians, key, "left").select(key, "median", *counts)


def drift_verdict(ratios: DataFrame) -> DataFrame:
    """Per channel: sample, median ratio, share of extreme ratios and the verdict."""
    measured = median_and_counts(
        ratios,
        "channel",
        "ratio",
        sample=F.count("ratio"),
        extreme=F.count_if(_extreme(F.col("ratio"))),
    )
    share = F.try_divide(F.col("extreme"), F.col("sample"))
    sound = F.col("median").between(*GUARD_MEDIAN) & (share <= GUARD_EXTREME_SHARE)
    return measured.select(
        "channel",
        "sample",
        F.col("median").alias("median_ratio"),
        share.alias("extreme_share"),
        ((F.col("sample") < GUARD_MIN_SAMPLE) | F.coalesce(sound, F.lit(False))).alias("passed"),
    )


def drift_guard(links: DataFrame, snapshot: DataFrame, latest: DataFrame) -> DataFrame:
    return drift_verdict(guard_rows(links, snapshot, latest))


def coverage_gate(links: DataFrame, snapshot: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per batch channel: snapshot size, requested keys, found keys and the verdict."""
    gates = thresholds.withColumn("channel", F.lower("platform"))
    items = snapshot.groupBy("channel").agg(F.count("*").alias("items"))
    held = snapshot.select(*BATCH_KEY, F.lit(True).alias("__held"))  # one row a key
    requested = requested_keys(links).join(held, BATCH_KEY, "left").groupBy("channel").agg(
        F.count("*").alias("requested"), F.count("__held").alias("matched")
    )
    counts = (
        gates.join(items, "channel", "left")
        .join(requested, "channel", "left")
        .fillna(0, ["items", "requested", "matched"])
    )
    coverage = F.coalesce(F.try_divide(F.col("matched"), F.col("requested")), F.lit(0.0))
    return counts.select(
        "channel",
        "items",
        "requested",
        "matched",
        coverage.alias("coverage"),
        ((F.col("items") >= F.col("min_items")) & (coverage >= F.col("min_coverage"))).alias("passed"),
    )


def gated_snapshot(snapshot: DataFrame, coverage: DataFrame, drift: DataFrame) -> DataFrame:
    """Snapshot rows of the channels that passed; one failed check voids the whole channel.

    Only a true verdict passes. A channel that the guard does not list had no comparable
    price at all, which is no reason to stop it; a listed one without a verdict is stopped.
    The verdicts have one row per registered channel, so they are broadcast instead of
    shuffling the snapshot by its few channels.
    """
    stopped = drift.filter(~F.coalesce(F.col("passed"), F.lit(False)))
    passed = (
        coverage.filter(F.coalesce(F.col("passed"), F.lit(False)))
        .select("channel")
        .join(stopped, "channel", "left_anti")
    )
    return snapshot.join(F.broadcast(passed), "channel", "left_semi")
