"""Intermediate tables in the shared scratch folder.

A staged table cuts lineage, survives lost executors, and gives Catalyst the
real size of a result that a static plan can only guess from its input. Joins
against one need no hint: Spark broadcasts it when its files are below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise uses a sort-merge join,
whose skewed partitions AQE splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gaugeline.session import scratch_dir

# Below Spark's default broadcast threshold of 10 MB.
SMALL_BYTES = 8 * 1024 * 1024


def stage_root(spark: SparkSession) -> str:
    """Folder for everything this application stages."""
    return f"{scratch_dir(spark)}/gaugeline/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path; never reused, so a failed attempt leaves nothing half-read."""
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Stage ``df`` unless the optimizer already bounds it below a broadcast's size.

    The optimizer bounds an aggregate by its input, so without this a few
    thousand groups over a large table would be planned as a shuffle of that table.
    """
    bound = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df if int(str(bound)) <= SMALL_BYTES else stage(df, label)


def delete_path(spark: SparkSession, uri: str) -> None:
    """Delete a folder on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_stages(spark: SparkSession) -> None:
    """Delete what this application staged; call it once its results are written."""
    delete_path(spark, stage_root(spark))
