"""What each captured page adds, and where paging ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pricewatch.operators.ordered import previous_row, running_total


def page_novelty(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """New products per page of a query, and the running total.

    A product belongs to its first page, so two combined aggregates replace a scan in
    page order; pages that add nothing are kept with zero.
    """
    first_page = cards.groupBy("query", "product_key").agg(F.min("page").alias("page"))
    added = first_page.groupBy("query", "page").agg(F.count("*").alias("new_items"))
    counted = pages.join(added, ["query", "page"], "left").fillna(0, ["new_items"])
    return running_total(counted, ["query"], "page", "new_items", "total_items")


def stop_page_single(novelty: DataFrame) -> DataFrame:
    """First page after page 1 that adds nothing; null when paging ran to the end."""
    empty = (F.col("new_items") == 0) & (F.col("page") > 1)
    return novelty.groupBy("query").agg(F.min(F.when(empty, F.col("page"))).alias("stop_page"))


def stop_page_double(novelty: DataFrame) -> DataFrame:
    """Second of two consecutive pages that add nothing."""
    paired = previous_row(novelty, ["query"], "page", ["new_items"], "before")
    empty = (F.col("new_items") == 0) & (F.col("before.new_items") == 0)
    return paired.groupBy("query").agg(F.min(F.when(empty, F.col("page"))).alias("stop_page"))


def stop_pages(novelty: DataFrame) -> DataFrame:
    """Both stops of each query from one pass: ``stop_page`` (single) and ``double_stop``."""
    paired = previous_row(novelty, ["query"], "page", ["new_items"], "before")
    empty = F.col("new_items") == 0
    return paired.groupBy("query").agg(
        F.min(F.when(empty & (F.col("page") > 1), F.col("page"))).alias("stop_page"),
        F.min(F.when(empty & (F.col("before.new_items") == 0), F.col("page"))).alias("double_stop"),
    )


def stop_page_failures(novelty: DataFrame) -> DataFrame:
    """Second of two consecutive failed pages, or a fetched later page that adds nothing."""
    fetched = F.col("http_status") == 200
    paired = previous_row(novelty, ["query"], "page", ["http_status"], "before")
    ends = (~fetched & (F.col("before.http_status") != 200)) | (
        fetched & (F.col("new_items") == 0) & (F.col("page") > 1)
    )
    return paired.groupBy("query").agg(F.min(F.when(ends, F.col("page"))).alias("stop_page"))


def before_stop(cards: DataFrame, stops: DataFrame) -> DataFrame:
    """Cards of the pages up to the stop; later pages are ignored."""
    return (
        cards.join(stops, "query", "left")
        .filter(F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page")))
        .drop("stop_page")
    )


def first_pages(pages: DataFrame, limit: int) -> DataFrame:
    """The first pages of each query."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy("page"))
    return pages.withColumn("__rank", rank).filter(F.col("__rank") <= limit).drop("__rank")
