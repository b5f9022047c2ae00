"""Results staged as they arrive, promoted to the log when the run is complete."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pricewatch.folders import make_folder, partitions, remove
from pricewatch.operators.match import trend_join
from pricewatch.sinks import append_success


def result_stream(spark: SparkSession, schema, path: str, files: str = "*.parquet",
                  max_bytes: str | None = None) -> DataFrame:
    """Result files as a stream; ``max_bytes`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def stamped(results: DataFrame) -> DataFrame:
    """Date and time of completion; a row that already carries them keeps them."""
    now = F.current_timestamp()
    stamps = {"obs_date": F.date_format(now, "yyyy-MM-dd"), "obs_time": F.date_format(now, "HH:mm:ss")}
    return results.withColumns(
        {c: F.coalesce(F.col(c), v) if c in results.columns else v for c, v in stamps.items()}
    )


def stage_results(results: DataFrame, staging: str, checkpoint: str) -> StreamingQuery:
    """Stage each micro-batch as a whole.

    A batch is written to a folder of its own attempt. A pointer, an empty folder made in
    one step and named for batch and attempt, then says which attempt counts, so readers
    see a batch whole or not at all, also while a batch that failed is run again. Earlier
    attempts are removed one replacement later, when readers that began before are done.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        attempt = uuid.uuid4().hex
        batch.write.parquet(f"{staging}/data/batch={batch_id}/attempt={attempt}")
        commit(spark, staging, batch_id, attempt)

    return (
        stamped(results)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def commit(spark: SparkSession, staging: str, batch_id: int, attempt: str) -> None:
    """Let ``attempt`` be what readers see of the batch, by a pointer of the next number."""
    mine = f"batch={batch_id:020d},number"
    pointers = partitions(spark, f"{staging}/pointers", mine)
    number = int(pointers[-1].partition(",")[0]) + 1 if pointers else 0
    make_folder(spark, f"{staging}/pointers/{mine}={number:020d},attempt={attempt}")
    for old in pointers[:-1]:  # the last one before this may still be read
        remove(spark, f"{staging}/data/batch={batch_id}/attempt={old.rpartition('=')[2]}")
        remove(spark, f"{staging}/pointers/{mine}={old}")


def committed(spark: SparkSession, staging: str) -> list[str]:
    """Folders of the attempts that count, one for each batch, from the names of the pointers alone."""
    newest = {}
    for name in sorted(partitions(spark, f"{staging}/pointers", "batch")):
        batch, _, rest = name.partition(",")
        newest[int(batch)] = rest.rpartition("=")[2]
    return [f"{staging}/data/batch={batch}/attempt={attempt}" for batch, attempt in newest.items()]


def staged(spark: SparkSession, staging: str, schema) -> DataFrame:
    """Results of the batches completed so far; none before the first."""
    folders = committed(spark, staging)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def promote(spark: SparkSession, staging: str, schema, log: str, run: str) -> None:
    """Write the successful staged rows to the log, once the stream has ended."""
    append_success(staged(spark, staging, schema), log, run)


def stream_trends(arriving: DataFrame, latest: DataFrame) -> DataFrame:
    """Classify arriving prices against the history as it was when the run began."""
    return trend_join(arriving, latest)
