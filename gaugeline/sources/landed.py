"""Landed files: station pages, GeoJSON feature collections and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.text import after_marker, last_segment
from gaugeline.schemas import FEATURE_COLLECTION, STATION_PAGE

CORRUPT = "_corrupt_record"
_FIRST_VERSION = "spark.sql.sources.useV1SourceList"


def _read_json(spark: SparkSession, path, schema: T.StructType, one_per_file: bool) -> DataFrame:
    """Schemas are always given: inference would change with the content of a page."""
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("multiLine", one_per_file)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_station_pages(spark: SparkSession, path, one_per_file: bool = True) -> DataFrame:
    """One row per page; unreadable text is kept in ``_corrupt_record``."""
    return _read_json(spark, path, STATION_PAGE, one_per_file)


def read_feature_collections(spark: SparkSession, path, one_per_file: bool = True) -> DataFrame:
    """One row per collection; unreadable text is kept in ``_corrupt_record``."""
    return _read_json(spark, path, FEATURE_COLLECTION, one_per_file)


def read_observations(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files, directories or globs, read as one table."""
    return spark.read.parquet(*paths)


def page_stations(pages: DataFrame) -> DataFrame:
    """One row per station URL of every page, the last page (no ``next``) included."""
    return pages.select(
        F.explode("observationStations").alias("station_url"),
        F.col("pagination.next").alias("next_page"),
    )


def page_cursors(pages: DataFrame) -> DataFrame:
    """The distinct next pages and their cursors."""
    following = pages.select(F.col("pagination.next").alias("next_page")).filter(
        F.col("next_page").isNotNull()
    )
    return following.distinct().withColumn("cursor", after_marker(F.col("next_page")))


def page_links(pages: DataFrame) -> DataFrame:
    """The address of every page and of the next one, for ``operators.chains``."""
    return pages.select("page", F.col("pagination.next").alias("next"))


def station_keys(stations: DataFrame) -> DataFrame:
    return stations.withColumn("station_id", last_segment(F.col("station_url")))


def explode_features(collections: DataFrame) -> DataFrame:
    """One ``observation`` per feature of readable documents; empty and NULL collections give none."""
    readable = collections.filter(F.col(CORRUPT).isNull()) if CORRUPT in collections.columns else collections
    return readable.select(F.explode("features").alias("observation"))


def unreadable_documents(collections: DataFrame) -> DataFrame:
    """Documents that could not be read in full, as rejects: reason and text."""
    # Spark refuses to read the text alone, so the parsed column takes part in a filter.
    parsed = F.coalesce(F.size("features"), F.lit(0)) >= 0
    broken = collections.filter(F.col(CORRUPT).isNotNull() & parsed)
    return broken.select(F.lit("unreadable document").alias("reason"), F.col(CORRUPT).alias("record"))


def land_rejects(rejects: DataFrame, path: str) -> None:
    """Land rejects as Parquet."""
    rejects.write.parquet(path)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Number of rejects by reason."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def read_footers(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files as a version 2 scan, whose counts and bounds come from footers.

    Needs ``spark.sql.parquet.aggregatePushdown``, which ``build_session`` sets and
    this function sets where it is off.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    kept = spark.conf.get(_FIRST_VERSION)
    formats = [f for f in kept.split(",") if f.strip() != "parquet"]
    spark.conf.set(_FIRST_VERSION, ",".join(formats))
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)
    finally:
        spark.conf.set(_FIRST_VERSION, kept)


def write_landed(df: DataFrame, path: str) -> None:
    """Land rows as Snappy Parquet."""
    df.write.option("compression", "snappy").parquet(path)
