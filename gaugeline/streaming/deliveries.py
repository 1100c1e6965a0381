"""Deliveries with nothing lost from sight: every row is landed, a repeat or late, and counted.

A watermark drops late rows and repeats without a trace. Here each batch is
compared with what the batches before it left in the target:

- a row more than ``delay`` older than the newest row of earlier batches is late,
  and is landed with its reason among the rejects;
- a row whose key was landed before, or stands in the batch before it, is a repeat;
- all others are landed.

Keys are compared with landed rows within ``delay`` of the newest one only, in
partitions by day: older ones could only match rows that are late anyway. A
retried batch replaces its own folders, so counts and rows stay those of one
delivery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.skew import null_safe_join
from gaugeline.operators.stage import stage
from gaugeline.streaming.ingest import write_batches

LANDED, REPEATED, LATE = "landed", "repeated", "late"
_DAY = "_day"


def land_deliveries(
    stream: DataFrame, keys: list[str], time: str, delay_seconds: int, target: str, checkpoint: str
) -> None:
    """Sort all available rows of ``stream`` into landed, repeated and late ones below ``target``.

    Rows without ``time`` are never late; their repeats are found among landed rows without time.
    """
    write = _write_batch(keys, time, delay_seconds, target, stream)
    write_batches(stream, write, checkpoint, "append")


def read_landed(spark: SparkSession, target: str, stream: DataFrame) -> DataFrame:
    """The rows landed so far, each key once."""
    return _rows(spark, target, stream).drop("_batch", _DAY)


def read_late(spark: SparkSession, target: str, stream: DataFrame) -> DataFrame:
    """The rows that came too late, with their reason and batch."""
    return spark.read.schema(_with(stream, "reason string, _batch long")).parquet(f"{target}/late")


def read_counts(spark: SparkSession, target: str) -> DataFrame:
    """Rows per batch and outcome; the outcomes of a batch add up to what was delivered."""
    schema = "outcome string, row_count long, newest timestamp, _batch long"
    return spark.read.schema(schema).parquet(f"{target}/counts").withColumnRenamed("_batch", "batch").drop("newest")


def _with(stream: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema), more])


def _rows(spark: SparkSession, target: str, stream: DataFrame) -> DataFrame:
    return spark.read.schema(_with(stream, f"_batch long, {_DAY} date")).parquet(f"{target}/landed")


def _make(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def _write_batch(
    keys: list[str], time: str, delay_seconds: int, target: str, stream: DataFrame
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for name in ("landed", "late", "counts"):
            _make(spark, f"{target}/{name}")
        counts = spark.read.schema("newest timestamp, _batch long").parquet(f"{target}/counts")
        newest = counts.filter(F.col("_batch") < batch_id).agg(F.max("newest")).first()[0]
        since = F.lit(newest).cast("timestamp") - F.make_dt_interval(secs=F.lit(float(delay_seconds)))
        late = F.coalesce(F.col(time).cast("timestamp") < since, F.lit(False)) if newest else F.lit(False)

        kept = stage(batch.withColumn("_row", F.monotonically_increasing_id()), "delivered")
        first = kept.filter(~late).groupBy(*keys).agg(F.min("_row").alias("_first"))
        before = _rows(spark, target, stream).filter(F.col("_batch") < batch_id)
        if newest:
            recent = (F.col(_DAY) >= F.to_date(since)) | F.col(_DAY).isNull()
            before = before.filter(recent)
        fresh = null_safe_join(first, before.select(*keys), keys, "left_anti").select(F.col("_first").alias("_row"))
        fresh = fresh.withColumn("_fresh", F.lit(True))
        marked = kept.join(fresh, "_row", "left").withColumn(
            "outcome", F.when(late, LATE).when(F.col("_fresh"), LANDED).otherwise(REPEATED)
        )
        marked = stage(marked.drop("_row", "_fresh"), "marked-deliveries")

        def save(df: DataFrame, name: str, *parts: str) -> None:
            numbered = df.withColumn("_batch", F.lit(batch_id).cast("long"))
            writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("_batch", *parts).parquet(f"{target}/{name}")

        landed = marked.filter(F.col("outcome") == LANDED).drop("outcome")
        save(landed.withColumn(_DAY, F.to_date(time)), "landed", _DAY)
        reason = F.format_string(f"more than {delay_seconds} s before %s", F.lit(newest).cast("timestamp").cast("string"))
        save(marked.filter(F.col("outcome") == LATE).drop("outcome").withColumn("reason", reason), "late")
        # Written last: a batch counts for later ones once all of it is there.
        summary = marked.groupBy("outcome").agg(
            F.count(F.lit(1)).alias("row_count"), F.max(F.col(time).cast("timestamp")).alias("newest")
        )
        save(summary, "counts")

    return write
