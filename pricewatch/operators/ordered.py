"""Ordered work inside groups that may be too large for one task.

A plain window sorts each group in a single task. Here a group is cut into blocks of
consecutive positions; each block is ordered on its own, and one summary row per block
carries what the next block needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 1 << 16


def _block(order: str, size: int) -> Column:
    return F.floor(F.col(order) / size).alias("__block")


def previous_row(rows: DataFrame, keys: list[str], order: str, fields: list[str], alias: str,
                 block: int = BLOCK) -> DataFrame:
    """Add a struct of ``fields`` of the preceding row of the group, null for the first."""
    blocked = rows.select("*", _block(order, block))
    in_block = Window.partitionBy(*keys, "__block").orderBy(order)
    carried = blocked.groupBy(*keys, "__block").agg(
        F.max(F.struct(order, F.struct(*fields).alias("__fields"))).getField("__fields").alias("__last")
    )
    by_block = Window.partitionBy(*keys).orderBy("__block")
    carried = carried.select(*keys, "__block", F.lag("__last").over(by_block).alias("__carry"))
    return (
        blocked.withColumn("__near", F.lag(F.struct(*fields)).over(in_block))
        .join(carried, [*keys, "__block"], "left")
        .withColumn(alias, F.coalesce("__near", "__carry"))
        .drop("__near", "__carry", "__block")
    )


def running_total(rows: DataFrame, keys: list[str], order: str, value: str, alias: str,
                  block: int = BLOCK) -> DataFrame:
    """Add the inclusive running sum of ``value`` over ``order``."""
    blocked = rows.select("*", _block(order, block))
    so_far = Window.partitionBy(*keys, "__block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy(*keys, "__block").agg(F.sum(value).alias("__sum"))
    offsets = sums.select(
        *keys, "__block", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset")
    )
    return (
        blocked.withColumn("__within", F.sum(value).over(so_far))
        .join(offsets, [*keys, "__block"])
        .withColumn(alias, F.col("__within") + F.col("__offset"))
        .drop("__within", "__offset", "__block")
    )
