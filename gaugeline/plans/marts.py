"""Fact table, daily rollup, station dimension and temperature anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.timeparts import day_of_week, day_start, hour_of
from gaugeline.operators.ordering import number_rows
from gaugeline.operators.skew import HOT_ROWS
from gaugeline.operators.zscore import UNUSUAL_ABOVE, category, with_zscore
from gaugeline.plans.daily import Rollup, rolled_up
from gaugeline.plans.staging import STAGED_COLUMNS

TIE_BREAKERS = [name for name in STAGED_COLUMNS if name != "observation_timestamp"]


def with_time_parts(staged: DataFrame) -> DataFrame:
    """Add the day, hour and weekday of each observation."""
    ts = F.col("observation_timestamp")
    return staged.withColumns(
        {
            "observation_date": day_start(staged, "observation_timestamp"),
            "observation_hour": hour_of(ts),
            "day_of_week": day_of_week(ts),
        }
    )


def fact_observations(
    staged: DataFrame, tie: list[str] | None = None, hot_rows: int = HOT_ROWS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Staged rows with a dense ``observation_id`` in time order and the time parts.

    ``tie`` orders rows of the same instant. Without it all staged columns do, so
    the numbering is still reproducible. ``keep`` names further columns to carry along.
    """
    numbered = number_rows(
        staged, "observation_timestamp", tie or TIE_BREAKERS, "observation_id", hot_rows
    )
    enriched = with_time_parts(numbered)
    return enriched.select(
        *keep,
        "observation_id",
        "observation_timestamp",
        *(name for name in STAGED_COLUMNS if name != "observation_timestamp"),
        "observation_date",
        "observation_hour",
        "day_of_week",
    )


# The columns of the daily model.
DAILY_KEYS = ["station_id", "location", "observation_date"]
DAILY = Rollup(
    (
        ("avg_temperature_degC", "temperature_degC", F.avg),
        ("min_temperature_degC", "temperature_degC", F.min),
        ("max_temperature_degC", "temperature_degC", F.max),
        ("avg_humidity_pct", "humidity_pct", F.avg),
        ("avg_wind_speed_mps", "wind_speed_mps", F.avg),
        ("max_wind_speed_mps", "wind_speed_mps", F.max),
        ("avg_pressure_mb", "pressure_mb", F.avg),
    )
)


def daily_weather(observations: DataFrame) -> DataFrame:
    """Station-day rollup of a fact table, or of ``with_time_parts`` rows: no id is needed."""
    return rolled_up(observations, DAILY_KEYS, DAILY)


def station_dimension(staged: DataFrame) -> DataFrame:
    """First, last and number of observations per station and location."""
    return (
        staged.filter(F.col("station_id").isNotNull())
        .groupBy("station_id", "location")
        .agg(
            F.min("observation_timestamp").alias("first_observation"),
            F.max("observation_timestamp").alias("last_observation"),
            F.count(F.lit(1)).alias("total_observations"),
        )
    )


def classify(observations: DataFrame, spread: DataFrame | None = None) -> DataFrame:
    """Every row with its z-score and category; a row without a score is Normal."""
    scored = with_zscore(observations, "station_id", "temperature_degC", spread)
    return scored.withColumn("temperature_category", category(F.col("temp_z_score")))


def extreme_events(
    fact: DataFrame, spread: DataFrame | None = None, above: float = UNUSUAL_ABOVE
) -> DataFrame:
    """Observations more than ``above`` deviations from their station's mean temperature."""
    return (
        classify(fact, spread)
        .filter(F.col("temp_z_score") > above)
        .select(
            "observation_id",
            "observation_timestamp",
            "station_id",
            "temperature_degC",
            "avg_temp",
            "stddev_temp",
            "temp_z_score",
            "temperature_category",
        )
    )
