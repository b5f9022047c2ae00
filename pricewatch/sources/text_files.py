"""Lines of text files, numbered from 1, for files larger than a split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricewatch.session import written


def numbered_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """``(file, line_no, line, file_mtime)`` of the files; a large file is read by several tasks.

    The lines are read once and written with ids that rise within a split. A line's number
    is its distance from the first id of its split, plus the lines of the splits before it:
    both come from the written rows, and only one count per split is ever ordered.
    """
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__split"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        F.monotonically_increasing_id().alias("__id"),
        F.col("value").alias("line"),
    )
    raw = written(raw, "lines")
    splits = raw.groupBy("file", "__split").agg(F.min("__id").alias("__first"), F.count("*").alias("__lines"))
    earlier = Window.partitionBy("file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "__split", "__first", F.coalesce(F.sum("__lines").over(earlier), F.lit(0)).alias("__before"))
    return raw.join(starts, ["file", "__split"]).select(
        "file", (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("line_no"), "line", "file_mtime"
    )
