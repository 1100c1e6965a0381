"""Incremental ingest: every landed file is loaded once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"
# Reports that a query keeps, and the seconds after which they are read again.
_KEPT, _SECONDS = 1000, 1


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the files landed below ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Write everything available to Parquet files below ``target`` and stop.

    The checkpoint records the files read and the sink's log the files written, so
    a rerun or a restart after a failure adds only what is new.
    """
    (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def write_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> int:
    """Hand every available micro-batch to ``write`` and stop.

    Returns the number of rows that stateful operators dropped as too late. Reports of
    batches are added up while the query runs, so a run may have any number of them.
    """
    conf = stream.sparkSession.conf
    kept = conf.get(_PROGRESS, None)
    conf.set(_PROGRESS, str(_KEPT))
    late, last, ended = 0, ("", -1), False
    try:
        query = (
            stream.writeStream.foreachBatch(write)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        while not ended:
            ended = query.awaitTermination(_SECONDS)
            for progress in query.recentProgress:
                key = (progress["timestamp"], progress["batchId"])
                if key > last:
                    late += sum(state["numRowsDroppedByWatermark"] for state in progress["stateOperators"])
                    last = key
    finally:
        conf.unset(_PROGRESS) if kept is None else conf.set(_PROGRESS, kept)
    return late
