"""Daily rollup over a stream of staged observations.

``windowed_daily`` keeps open days in the state store and suits a stream whose
rows arrive near their time. ``land_partials`` keeps no state: each batch leaves
its own pieces, which merge in any order, so rows may come as late as they like.

Every batch has a folder ``batch-N`` below the target. ``merge_batches`` puts the
batches so far together as ``upto-N``; readers take the newest such folder that
is complete and the batches after it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.spread import finished_spread, merge_spread, spread_pieces
from gaugeline.operators.stage import delete_path
from gaugeline.plans.marts import DAILY, DAILY_KEYS
from gaugeline.streaming.ingest import write_batches


def windowed_daily(stream: DataFrame, delay: str, time: str = "observation_timestamp") -> DataFrame:
    """Pieces per station and tumbling day; rows later than ``delay`` are dropped."""
    day = F.window(time, "1 day")
    return (
        stream.withWatermark(time, delay)
        .groupBy("station_id", "location", day.alias("_day"))
        .agg(*DAILY.pieces())
        .withColumn("observation_date", F.col("_day.start"))
        .drop("_day")
    )


def _write_batch(target: str, change: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A retried batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = change(batch).withColumn("batch", F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{target}/batch-{batch_id}")

    return write


def land_windowed(stream: DataFrame, delay: str, target: str, checkpoint: str) -> int:
    """Run ``windowed_daily`` on all available input; every batch leaves its changed days.

    Returns the number of rows that came too late and were dropped.
    """
    write = _write_batch(target, lambda batch: batch)
    return write_batches(windowed_daily(stream, delay), write, checkpoint, "update")


def land_partials(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Leave each batch's pieces in a folder of its own."""
    write = _write_batch(target, lambda batch: batch.groupBy(*DAILY_KEYS).agg(*DAILY.pieces()))
    write_batches(stream, write, checkpoint, "append")


def land_spread(stream: DataFrame, keys: list[str], value: str, target: str, checkpoint: str) -> None:
    """Leave each batch's count, mean and squared deviations of ``value`` in a folder of its own."""
    write = _write_batch(target, lambda batch: spread_pieces(batch, keys, value))
    write_batches(stream, write, checkpoint, "append")


def _folders(spark: SparkSession, target: str) -> tuple[list[str], list[str], int]:
    """(folders to read, folders they replace, last batch); one entry per unmerged batch."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        match = re.fullmatch(r"(batch|upto)-(\d+)", status.getPath().getName())
        done = match and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        if done:
            found.append((match[1], int(match[2]), status.getPath().toString()))
    merged = max((n for kind, n, _ in found if kind == "upto"), default=-1)
    current = [p for kind, n, p in found if n > merged or (kind == "upto" and n == merged)]
    return current, [p for _, _, p in found if p not in current], max((n for _, n, _ in found), default=-1)


def _newest(versions: DataFrame) -> DataFrame:
    """The newest version of every station-day."""
    pieces = F.struct(*(name for name in versions.columns if name not in DAILY_KEYS))
    return versions.groupBy(*DAILY_KEYS).agg(F.max_by(pieces, "batch").alias("_newest")).select(*DAILY_KEYS, "_newest.*")


def _added(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy(*DAILY_KEYS).agg(*DAILY.merged(), F.max("batch").alias("batch"))


def added_spread(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """How ``merge_batches`` puts the folders of ``land_spread`` together."""
    return lambda pieces: merge_spread(pieces, keys).withColumn("batch", F.lit(None).cast("long"))


def _read(spark: SparkSession, target: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return merge(spark.read.parquet(*_folders(spark, target)[0]))


def read_windowed(spark: SparkSession, target: str) -> DataFrame:
    """The rollup of what ``land_windowed`` left."""
    return _read(spark, target, _newest).select(*DAILY_KEYS, *DAILY.finished())


def read_partials(spark: SparkSession, target: str) -> DataFrame:
    """The rollup of what ``land_partials`` left."""
    return _read(spark, target, _added).select(*DAILY_KEYS, *DAILY.finished())


def read_spread(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """Mean and deviation per ``keys`` of all values that ``land_spread`` saw."""
    return finished_spread(_read(spark, target, lambda pieces: merge_spread(pieces, keys)))


def merge_batches(
    spark: SparkSession,
    target: str,
    windowed: bool = False,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Put the batches so far into one folder and delete those merged before.

    ``merge`` says how, for other pieces than those of the daily rollup.

    Folders just merged stay for running readers until the next merge. Run it
    between two runs of the stream.
    """
    current, replaced, last = _folders(spark, target)
    if len(current) > 1:
        merged = _read(spark, target, merge or (_newest if windowed else _added))
        merged.write.mode("overwrite").parquet(f"{target}/upto-{last}")
    for path in replaced:
        delete_path(spark, path)
