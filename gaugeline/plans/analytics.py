"""The analytical queries over one observations table.

Column names are parameters with the metric layout as default, so that the same
query runs on any table with a key, a time and measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.rounding import steady_avg
from gaugeline.functions.timeparts import day_start, hour_of, moment, month_of
from gaugeline.operators.order_stats import grouped_order_stats, percentile_cont
from gaugeline.operators.rolling import SERIES_ROWS, rolling_average, rolling_time_average
from gaugeline.operators.zscore import EXTREME_ABOVE, with_zscore
from gaugeline.plans.daily import Rollup, rolled_up

STATION = "station_id"
TIME = "observation_timestamp"
TEMPERATURE = "temperature_degC"


def full_scan(df: DataFrame) -> DataFrame:
    return df.select("*")


def count_rows(df: DataFrame) -> DataFrame:
    """Row count; of a table from ``landed.read_footers`` it comes from file footers alone."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def filtered_scan(
    df: DataFrame, key_value, start: str, end: str, key: str = STATION, time: str = TIME
) -> DataFrame:
    """All columns of one key in the half-open time range; both filters reach the scan."""
    return df.filter(
        (F.col(key) == key_value)
        & (F.col(time) >= moment(df, time, start))
        & (F.col(time) < moment(df, time, end))
    )


def daily_aggregation(
    df: DataFrame,
    key: str = STATION,
    time: str = TIME,
    temperature: str = TEMPERATURE,
    humidity: str = "relative_humidity_percent",
    wind: str = "wind_speed_kmh",
    pressure: str = "barometric_pressure_Pa",
) -> DataFrame:
    """Eight aggregates per key and day."""
    rollup = Rollup(
        (
            ("avg_temp", temperature, F.avg),
            ("min_temp", temperature, F.min),
            ("max_temp", temperature, F.max),
            ("avg_humidity", humidity, F.avg),
            ("avg_wind", wind, F.avg),
            ("max_wind", wind, F.max),
            ("avg_pressure", pressure, F.avg),
        )
    )
    dated = df.select(
        key, day_start(df, time).alias("observation_date"), *dict.fromkeys([temperature, humidity, wind, pressure])
    )
    return rolled_up(dated, [key, "observation_date"], rollup)


def anomaly_detection(
    df: DataFrame,
    row_key: str = "observation_id",
    key: str = STATION,
    time: str = TIME,
    value: str = TEMPERATURE,
    above: float = EXTREME_ABOVE,
    spread: DataFrame | None = None,
) -> DataFrame:
    """Rows more than ``above`` deviations from the mean of their key."""
    scored = with_zscore(df.select(row_key, time, key, value), key, value, spread)
    return scored.filter(F.col("temp_z_score") > above).select(
        row_key, time, key, value, "avg_temp", "stddev_temp", "temp_z_score"
    )


def station_dimension(
    df: DataFrame,
    keys: tuple[str, ...] = (STATION, "station_name", "elevation_m"),
    time: str = TIME,
    value: str = TEMPERATURE,
) -> DataFrame:
    """Count, span and mean per station, name and elevation."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.min(time).alias("first_observation"),
        F.max(time).alias("last_observation"),
        steady_avg(F.col(value)).alias("avg_temp"),
    )


def rolling_24(
    df: DataFrame,
    stations: list | None = None,
    tie: tuple[str, ...] = (),
    key: str = STATION,
    time: str = TIME,
    value: str = TEMPERATURE,
    hot_rows: int = SERIES_ROWS,
) -> DataFrame:
    """Mean of the last 24 rows of each station; ``tie`` orders rows of the same instant."""
    chosen = df if stations is None else df.filter(F.col(key).isin(stations))
    narrow = chosen.select(*dict.fromkeys([key, time, value, *tie]))
    return rolling_average(
        narrow, key, [time, *tie], value, "rolling_24h_avg", rows=24, hot_rows=hot_rows
    )


def rolling_day(
    df: DataFrame,
    keep: tuple[str, ...] = (),
    key: str = STATION,
    time: str = TIME,
    value: str = TEMPERATURE,
    hot_rows: int = SERIES_ROWS,
) -> DataFrame:
    """Mean of the last 24 hours of each station, both ends included; ``keep`` names further columns."""
    narrow = df.select(*dict.fromkeys([key, time, value, *keep]))
    return rolling_time_average(narrow, key, time, value, "rolling_24h_avg", hot_rows=hot_rows)


def monthly_percentiles(
    df: DataFrame,
    key: str = STATION,
    time: str = TIME,
    temperature: str = TEMPERATURE,
    wind: str = "wind_speed_kmh",
    precipitation: str = "precipitation_3h_mm",
    humidity: str = "relative_humidity_percent",
    rain_above: float = 0.0,
    humid_above: float = 80.0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Percentiles, conditional count and conditional mean per key and calendar month."""
    rows = df.select(
        key, month_of(F.col(time)).alias("month"), temperature, wind, precipitation, humidity
    )
    rainy = F.col(precipitation) > rain_above
    humid = F.col(humidity) > humid_above
    return grouped_order_stats(
        rows,
        [key, "month"],
        {
            "median_temp": percentile_cont(temperature, 0.5),
            "p95_wind": percentile_cont(wind, 0.95),
        },
        [
            F.count(F.lit(1)).alias("obs_count"),
            F.sum(F.when(rainy, 1).otherwise(0)).alias("precip_hours"),
            steady_avg(F.when(humid, F.col(temperature))).alias("avg_temp_humid"),
        ],
        hot_rows,
    )


def latest(
    df: DataFrame, columns: list[str], time: str = TIME, tie: tuple[str, ...] = (), n: int = 5
) -> DataFrame:
    """The ``n`` latest rows; each task keeps only its own ``n``."""
    order = [F.col(time).desc_nulls_last(), *(F.col(name) for name in tie)]
    return df.orderBy(*order).limit(n).select(*columns)


def load_stats(
    df: DataFrame, key: str = STATION, time: str = TIME, value: str = TEMPERATURE
) -> DataFrame:
    """Distinct stations, time span and temperature statistics in one pass."""
    return df.agg(
        F.count_distinct(key).alias("unique_stations"),
        F.min(time).alias("earliest_observation"),
        F.max(time).alias("latest_observation"),
        F.count(F.lit(1)).alias("row_count"),
        steady_avg(F.col(value)).alias("avg_temp_degC"),
        F.min(value).alias("min_temp_degC"),
        F.max(value).alias("max_temp_degC"),
    )


def warm_samples(
    df: DataFrame, columns: list[str], time: str, temperature: str, above: float = 20.0
) -> DataFrame:
    """``columns``, temperature and hour of readings above a limit, warmest first."""
    return (
        df.filter(F.col(temperature) > above)
        .select(*columns, temperature, hour_of(F.col(time)).alias("hour"))
        .orderBy(F.col(temperature).desc_nulls_last())
    )
