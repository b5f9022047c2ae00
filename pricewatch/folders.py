"""Folders of partitioned tables, known by their names."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name of the folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition column that have a folder, sorted; nothing is read."""
    folder, files = _located(spark, path)
    names = [e.getPath().getName() for e in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _located(spark, path)
    if files.exists(folder):
        files.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    folder, files = _located(spark, path)
    files.mkdirs(folder)
