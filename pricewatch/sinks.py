"""Writers of the price log, catalogue snapshots and recovery tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from pricewatch.fixed_values import CATALOG_COLUMNS, KEEP_DAYS, PRICE_LOG_COLUMNS, STATUS_OK
from pricewatch.folders import NO_VALUE, partitions, remove
from pricewatch.log_state import closing_path, latest_path, write_closing
from pricewatch.operators.reconcile import manifest_counts
from pricewatch.operators.recovery import conflicting_rows
from pricewatch.operators.retention import parsed_date


def _with_columns(rows: DataFrame, columns) -> DataFrame:
    """The fixed columns in order; a missing one is empty."""
    return rows.select(
        *(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns)
    )


def success_rows(results: DataFrame) -> DataFrame:
    return _with_columns(results.filter(F.col("status") == STATUS_OK), PRICE_LOG_COLUMNS)


def _balanced(rows: DataFrame, *partition_columns: str) -> DataFrame:
    """Gather each output partition into few files, and split one that is too large."""
    return rows.hint("rebalance", *partition_columns)


def _slice_days(rows: DataFrame) -> list[str]:
    """The days that rows belong to, as their folders are named: one short text for each."""
    days = rows.select(parsed_date(F.col("obs_date")).alias("day")).distinct().collect()
    return sorted(NO_VALUE if d.day is None else d.day.isoformat() for d in days)


def _remove_slice(spark, table: str, day: str, run: str) -> None:
    """Remove the folder of a run's day, and that of the day when nothing else is in it."""
    remove(spark, f"{table}/day={day}/run={run}")
    if not partitions(spark, f"{table}/day={day}", "run"):
        remove(spark, f"{table}/day={day}")


def write_log(rows: DataFrame, path: str, run: str, days: list[str] | None = None) -> None:
    """Write a run's rows to the price log, one folder per day and run, and their closing prices.

    The one writer of the log. ``days`` are the days that the run answers for, by default
    those of its rows. A run that is repeated replaces what it wrote to these days before,
    also where it has no row left, and touches no other run's rows.
    """
    spark = rows.sparkSession
    present = _slice_days(rows)
    placed = _with_columns(rows, PRICE_LOG_COLUMNS).withColumns(
        {"day": parsed_date(F.col("obs_date")), "run": F.lit(run)}
    )
    (
        _balanced(placed, "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "run")
        .parquet(path)
    )
    answered = {*(days or ()), *present}
    for day in answered - {*present}:
        _remove_slice(spark, path, day, run)
    for day in answered:
        _remove_slice(spark, closing_path(path), day, run)
    write_closing(spark, path, present, run)
    spark.catalog.refreshByPath(path)


def append_success(results: DataFrame, path: str, run: str) -> list[str]:
    """Write the successful rows of a run to the log; returns the days that the run has results of."""
    days = _slice_days(results)
    write_log(success_rows(results), path, run, days)
    return days


def read_price_log(spark, path: str, since: str | None = None) -> DataFrame:
    """The log; ``since`` reads only the folders of that day and later, and of undated rows."""
    log = spark.read.parquet(path)
    if since is not None:
        log = log.filter(F.col("day").isNull() | (F.col("day") >= F.lit(since).cast("date")))
    return log.select(*PRICE_LOG_COLUMNS)


def drop_expired_days(spark, path: str, keep_days: int = KEEP_DAYS) -> list[str]:
    """Remove the day folders before the rolling window and return their days.

    Days are known from the folder names, so no row is read or written. Undated rows stay.
    What is kept beside the log loses the same days.
    """
    days = [date.fromisoformat(d) for d in partitions(spark, path, "day") if d != NO_VALUE]
    expired = [day.isoformat() for day in days if day < max(days) - timedelta(days=keep_days)]
    for day in expired:
        for folder in (f"{path}/day={day}", f"{closing_path(path)}/day={day}", f"{latest_path(path)}/through={day}"):
            remove(spark, folder)
    spark.catalog.refreshByPath(path)
    return expired


def write_catalog(items: DataFrame, path: str) -> None:
    """Catalogue snapshot, one directory per platform, country and day.

    An empty catalogue writes no data file, and only the partitions present in the items
    are replaced.
    """
    rows = _with_columns(items, CATALOG_COLUMNS).withColumn("snapshot_date", F.to_date("scraped_at"))
    partitions = ("platform", "country", "snapshot_date")
    (
        _balanced(rows, *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_recovery(recovered: DataFrame, excluded: DataFrame, path: str) -> None:
    """Audit, excluded lines and manifest of one recovery."""
    recovered.write.mode("overwrite").parquet(f"{path}/audit")
    excluded.write.mode("overwrite").parquet(f"{path}/excluded")
    audit = recovered.sparkSession.read.parquet(f"{path}/audit")
    columns = [c for c in audit.columns if c not in ("obs_date", "platform")]
    manifest_counts(audit, columns).write.mode("overwrite").json(f"{path}/manifest")


class RecoveryConflict(RuntimeError):
    """The log already holds rows of the recovered days."""


def append_recovered(existing: DataFrame, recovered: DataFrame, path: str, run: str, write: bool = False) -> bool:
    """Add the recovered rows' days to the log; refuse when a target day is already logged."""
    if not write:
        return False
    if not conflicting_rows(existing, recovered).isEmpty():
        raise RecoveryConflict("the log already holds rows of the recovered dates and platforms")
    write_log(recovered, path, run)
    return True


def write_log_files(lines: DataFrame, path: str) -> None:
    """Run logs (run_id, line_no, line) as text files: each run's lines in order, in one file of its folder ``run=…``.

    Creating the files is the work, so the runs are dealt to a stated number of tasks.
    Adaptive execution goes by bytes, of which logs have few, and would leave one task.
    """
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartition(tasks, "run_id").sortWithinPartitions("run_id", "line_no")
    dealt.select("line", F.col("run_id").alias("run")).write.partitionBy("run").text(path)


def export_csv(rows: DataFrame, path: str) -> None:
    """Rows as CSV files with a header; cells keep blanks and line breaks at their ends."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.mode("overwrite").options(header=True, escape='"', **kept).csv(path)
