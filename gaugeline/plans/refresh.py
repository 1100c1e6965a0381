"""Marts kept up to date by what was landed, and numbers that never change again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.mutate import not_yet_landed
from gaugeline.operators.skew import HOT_ROWS, null_safe_join
from gaugeline.operators.stage import stage
from gaugeline.plans.marts import DAILY_KEYS, daily_weather, fact_observations
from gaugeline.sources import tables

# The tables are partitioned by this date.
DAY = "day"


def with_day(df: DataFrame, time: str = "observation_timestamp") -> DataFrame:
    """Add the date that the tables here are partitioned by."""
    return df.withColumn(DAY, F.to_date(time))


def touched_days(rows: DataFrame) -> list:
    """The days of ``rows``: one date per partition of the tables, so they may be listed."""
    return sorted(row[0] for row in rows.select(DAY).filter(F.col(DAY).isNotNull()).distinct().collect())


def of_days(df: DataFrame, days: list) -> DataFrame:
    """The partitions of ``days``; a list of literals, so others are not even opened."""
    return df.filter(F.col(DAY).isin(days)) if days else df.filter(F.lit(False))


def refresh_daily(spark: SparkSession, observations: str, mart: str, landed: DataFrame) -> list:
    """Bring the daily mart up to date with rows ``landed`` in ``observations``; returns the days changed.

    ``observations`` are staged rows with their time parts and ``mart`` is their
    daily rollup, both partitioned by ``day``. Station-days that ``landed`` touches
    are computed anew from the observations of these days, late rows and old
    ones alike; other station-days of the same partitions are carried over as
    they are, and other partitions are neither read nor written. Landed rows
    that are not in ``observations`` change nothing, so a repeated call, or one
    after a failure, comes to the same mart.
    """
    keys = [*DAILY_KEYS, DAY]
    touched = stage(with_day(landed.select(*DAILY_KEYS), "observation_date").distinct(), "touched-station-days")
    days = touched_days(touched)
    if not days:
        return days
    rows = null_safe_join(of_days(tables.read_table(spark, observations), days), touched, keys, "left_semi")
    kept = null_safe_join(of_days(tables.read_table(spark, mart), days), touched, keys, "left_anti")
    fresh = with_day(daily_weather(rows), "observation_date")
    tables.replace_partitions(stage(kept.unionByName(fresh), "refreshed-days"), mart)
    return days


def fact_increment(
    spark: SparkSession,
    fact: str,
    staged: DataFrame,
    keys: list[str],
    tie: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Append to the table ``fact`` the rows of ``staged`` whose ``keys`` it does not hold; returns them.

    ``fact`` is partitioned by ``day`` and holds ``keys`` beside the model's columns.
    New rows are numbered in time order after the highest number so far, so
    numbers stay dense and a row keeps its number whatever comes later: a late
    row gets a high number, and nothing is renumbered. Only new rows are
    sorted. The highest number is read from the table itself, so an append
    that failed left none behind; a second call with the same rows adds none.
    Keys are looked up in the partitions of the new rows' days only, as a
    redelivered row has its old time. There must be one writer at a time.
    """
    dated = with_day(staged)
    held = of_days(tables.read_table(spark, fact), touched_days(dated))
    fresh = stage(not_yet_landed(staged.dropDuplicates(keys), held, keys), "new-observations")
    high = high_mark(spark, fact, "observation_id")
    numbered = with_day(fact_observations(fresh, tie or keys, hot_rows, tuple(keys)))
    numbered = numbered.withColumn("observation_id", F.col("observation_id") + F.lit(high))
    added = stage(numbered, "numbered-observations")
    tables.append_rows(added, fact)
    return added


def high_mark(spark: SparkSession, name: str, column: str) -> int:
    """The highest number in a table's ``column``, 0 if it is empty; from file footers."""
    return tables.table_footers(spark, name).agg(F.max(column)).first()[0] or 0
