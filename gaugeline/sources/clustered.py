"""Tables clustered by a key: its rows lie together, so a key's scan and its rollups touch little.

A clustered table is two tables in the catalog. ``name`` is bucketed by the key
and sorted by key and time within its files: a filter on the key reads one
bucket, and in it the row groups whose bounds and Bloom filters admit the key;
a rollup by the key needs no exchange. A bucket is read by one task, so keys
above ``HOT_ROWS`` rows are kept out of the buckets: ``name_hot`` holds them in
order of key and time, in as many files as they need, and rolls up like any
table. No key stands in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.skew import HOT_ROWS, split_hot
from gaugeline.operators.stage import stage

# Rows of one bucket, and of one file of hot keys.
BUCKET_ROWS = 2_000_000
MOST_BUCKETS = 20_000


def save_clustered(
    df: DataFrame,
    name: str,
    folder: str,
    key: str,
    time: str,
    hot_rows: int = HOT_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> None:
    """Create the clustered table ``name`` with the rows of ``df``, below ``folder``; it must not exist.

    The number of buckets follows the number of rows. Rows without a key go to a bucket like any other.
    """
    df = stage(df, "to-cluster")
    cold, hot = split_hot(df, [key], hot_rows)
    rows = df.count()
    buckets = min(rows // bucket_rows + 1, MOST_BUCKETS)
    keys = df.agg(F.approx_count_distinct(key)).first()[0]

    def with_filters(writer: DataFrameWriter) -> DataFrameWriter:
        # The filter of a row group is sized for the keys of its bucket.
        expected = max(1, keys // buckets)
        return writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{key}", str(expected)
        )

    # The same hash deals rows and buckets: one file in every bucket.
    dealt = with_filters(cold.repartition(buckets, key).write)
    dealt.bucketBy(buckets, key).sortBy(key, time).option("path", f"{folder}/cold").saveAsTable(name)
    hot = df.limit(0) if hot is None else hot.withColumn("_tie", F.monotonically_increasing_id())
    order = [key, time, *(["_tie"] if "_tie" in hot.columns else [])]
    files = rows // bucket_rows + 1
    ordered = hot.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_tie")
    with_filters(ordered.write).option("path", f"{folder}/hot").saveAsTable(_hot(name))


def _hot(name: str) -> str:
    return f"{name}_hot"


def read_clustered(spark: SparkSession, name: str) -> DataFrame:
    """All rows."""
    return spark.table(name).unionByName(spark.table(_hot(name)))


def read_key(spark: SparkSession, name: str, key: str, value) -> DataFrame:
    """The rows of one key: one bucket, and of the hot keys the files that may hold it."""
    return read_clustered(spark, name).filter(F.col(key) == value)


def by_key(spark: SparkSession, name: str, rollup: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rollup`` of all rows, where it groups by the key among others.

    Both tables are rolled up by themselves, as no key stands in both: the
    bucketed one without an exchange, the hot keys after they combined on the map side.
    """
    return rollup(spark.table(name)).unionByName(rollup(spark.table(_hot(name))))


def drop_clustered(spark: SparkSession, name: str) -> None:
    """Drop both tables; their files stay."""
    for table in (name, _hot(name)):
        spark.sql(f"DROP TABLE IF EXISTS {table}")

