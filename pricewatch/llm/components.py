"""Connected components of a link table by alternating large-star and small-star steps.

Each step moves every link of a vertex to the smallest vertex next to it. Smallest
neighbours are minima that combine before the shuffle, so a vertex with a third of all
links sends one row per task; the join that follows is an ordinary one that adaptive
execution splits. Steps are written to the shared folder, and only a count of changed
links reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.session import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over (a, b) with a > b."""
    if large:
        ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        ends = links
    lowest = written(ends.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lowest")
    joined = ends.join(lowest, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, root): the smallest vertex reachable from each vertex that has a link."""
    now = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "links"
    )
    state = None
    while True:
        now = written(_star(now, large=True), "links")
        now = written(_star(now, large=False), "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        state = seen
