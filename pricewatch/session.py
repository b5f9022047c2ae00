"""Session defaults, and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "pricewatch", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**_DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Let adaptive execution split hot join keys, also where that costs a later shuffle."""
    for key in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a single-machine session gets one beside its warehouse;
    a cluster session is refused, because its executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master.startswith("local[") or master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
        folder = os.path.join(os.path.abspath(warehouse), "_shared")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/pricewatch/{spark.sparkContext.applicationId}"


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_written(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; for when no result that reads them is needed any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many tasks as shuffles have partitions.

    For costly work on few bytes, such as text rules or the making of files: splits and
    adaptive execution go by bytes, and would leave it to one task or a few.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder.

    For a result that several later steps read: it is computed once, and a lost executor
    costs a re-read instead of a re-computation.
    """
    path = new_table_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
