"""CSV files whose columns may differ in order and number, read by many tasks each."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewatch.operators.ordered import BLOCK, running_total
from pricewatch.session import written
from pricewatch.sources.text_files import numbered_lines

_BYTE_ORDER_MARK = "\ufeff"


def csv_records(spark: SparkSession, glob: str, block: int = BLOCK) -> DataFrame:
    """``(file, record_no, record, file_mtime)``: one row for each record, whole also where its cells hold line breaks.

    Lines are read wherever a split begins. A line begins a record when the quotes of all
    lines before it in the file are even in number, which a running total in blocks tells
    without a task that sees the whole file. Blank records go; the header is record 1.
    """
    lines = numbered_lines(spark, glob, "\n")
    line = F.when(F.col("line_no") == 1, F.ltrim("line", F.lit(_BYTE_ORDER_MARK))).otherwise(F.col("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    counted = running_total(
        lines.withColumn("line", line).withColumn("__quotes", quotes), ["file"], "line_no", "__quotes", "__so_far", block
    )
    begins = ((F.col("__so_far") - F.col("__quotes")) % 2 == 0).cast("int")
    placed = running_total(counted.withColumn("__begins", begins), ["file"], "line_no", "__begins", "record_no", block)
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    records = placed.groupBy("file", "record_no").agg(parts.alias("__parts"), F.max("file_mtime").alias("file_mtime"))
    text = F.rtrim(F.array_join(F.transform("__parts", lambda p: p["line"]), "\n"), F.lit("\r"))
    return records.select("file", "record_no", text.alias("record"), "file_mtime").where("record <> ''")


def _cells(record: Column, names: list[str]) -> list[Column]:
    """The named cells of a record; of a name that stands twice the first, and none for a blank one."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = F.from_csv(record, F.lit(schema), {"escape": '"'})
    first = {name: i for i, name in reversed(list(enumerate(names))) if name}
    return [parsed[f"c{i}"].alias(name) for name, i in sorted(first.items(), key=lambda x: x[1])]


def read_csv_by_header(spark: SparkSession, glob: str) -> DataFrame:
    """Every file read by its own header, as text columns, with ``file_mtime``.

    A column that some files lack is null in their rows. The different headers, not the
    files, reach the driver.
    """
    records = written(csv_records(spark, glob), "csv-records")
    first = records.groupBy("file").agg(F.min_by("record", "record_no").alias("header"), F.min("record_no").alias("header_no"))
    headed = records.join(first, "file").where("record_no > header_no")
    together = None
    for row in first.select("header").distinct().orderBy("header").collect():
        names = [cell.strip() for cell in next(csv.reader([row["header"]]))]
        rows = headed.where(F.col("header") == row["header"]).select(*_cells(F.col("record"), names), "file_mtime")
        together = rows if together is None else together.unionByName(rows, allowMissingColumns=True)
    if together is None:
        raise ValueError(f"no CSV file with a header matches {glob}")
    return together
