"""Run logs as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewatch.sources.text_files import numbered_lines


def log_lines(logs: DataFrame) -> DataFrame:
    """Captured log texts, one row per run, to lines numbered from 1."""
    kept = [c for c in logs.columns if c != "body"]
    body = F.regexp_replace("body", r"\r?\n\z", "")
    lines = logs.filter(F.col("body") != "").select(
        *kept, F.posexplode(F.split(body, r"\r\n|\n|\r")).alias("__i", "line")
    )
    return lines.select(*kept, (F.col("__i") + 1).cast("long").alias("line_no"), "line")


#: The run of a log file: its name without the ending.
FILE_STEM = r"([^/]*?)(?:\.[^./]*)?$"


def read_log_files(spark: SparkSession, path: str, run: str = FILE_STEM) -> DataFrame:
    """Log files to ``(run_id, line_no, line)``, one run per file; ``run`` finds the run id in a file's path."""
    lines = numbered_lines(spark, path)
    return lines.select(F.regexp_extract("file", run, 1).alias("run_id"), "line_no", "line")
