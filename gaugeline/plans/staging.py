"""Staged observations: one layout from either raw schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import units
from gaugeline.functions.rounding import round_to

# The staged layout, without the load time.
STAGED_COLUMNS = [
    "station_id",
    "location",
    "observation_timestamp",
    "temperature_degC",
    "temperature_f",
    "humidity_pct",
    "wind_speed_mps",
    "wind_speed_mph",
    "pressure_mb",
    "condition",
]


def _number(name: str) -> Column:
    """The column with NaN as NULL, so that one bad reading does not poison an average."""
    return F.nanvl(F.col(name), F.lit(None))


def from_imperial(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stage °F, mph and mb readings; rows without a time are dropped.

    ``keep`` names further raw columns to carry along, such as a row key.
    """
    fahrenheit, mph = _number("temperature_f"), _number("wind_speed_mph")
    return raw.filter(F.col("observation_time").isNotNull()).select(
        *keep,
        F.col("station").alias("station_id"),
        "location",
        F.col("observation_time").alias("observation_timestamp"),
        round_to(units.fahrenheit_to_celsius(fahrenheit), 2).alias("temperature_degC"),
        fahrenheit.alias("temperature_f"),
        _number("humidity_pct").alias("humidity_pct"),
        round_to(units.mph_to_mps(mph), 2).alias("wind_speed_mps"),
        mph.alias("wind_speed_mph"),
        _number("pressure_mb").alias("pressure_mb"),
        "condition",
    )


def imperial_view(raw: str, keep: tuple[str, ...] = ()) -> str:
    """The SQL of ``from_imperial`` over the table ``raw``, with the time of the query, for a view."""

    def number(name: str) -> str:
        return f"nanvl({name}, CAST(NULL AS DOUBLE))"

    def rounded(value: str) -> str:
        scaled = f"({value} * 100D)"
        whole = f"signum({scaled}) * floor(abs({scaled}) + 0.49999999999999994D)"
        return f"CASE WHEN abs({scaled}) < 4503599627370496D THEN {whole} / 100D ELSE {value} END"

    fahrenheit, mph = number("temperature_f"), number("wind_speed_mph")
    celsius = f"(({fahrenheit} - 32D) * (5D / 9D))"
    columns = [
        *keep,
        "station AS station_id",
        "location",
        "observation_time AS observation_timestamp",
        f"{rounded(celsius)} AS temperature_degC",
        f"{fahrenheit} AS temperature_f",
        f"{number('humidity_pct')} AS humidity_pct",
        f"{rounded(f'({mph} * 0.44704D)')} AS wind_speed_mps",
        f"{mph} AS wind_speed_mph",
        f"{number('pressure_mb')} AS pressure_mb",
        "condition",
        "current_timestamp() AS ingestion_timestamp",
    ]
    return f"SELECT {', '.join(columns)} FROM {raw} WHERE observation_time IS NOT NULL"


def from_metric(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stage °C, km/h and Pa readings in the layout of ``from_imperial``."""
    celsius, kmh = _number("temperature_degC"), _number("wind_speed_kmh")
    mps = units.kmh_to_mps(kmh)
    return raw.filter(F.col("observation_timestamp").isNotNull()).select(
        *keep,
        "station_id",
        F.col("station_name").alias("location"),
        "observation_timestamp",
        round_to(celsius, 2).alias("temperature_degC"),
        round_to(units.celsius_to_fahrenheit(celsius), 2).alias("temperature_f"),
        _number("relative_humidity_percent").alias("humidity_pct"),
        round_to(mps, 2).alias("wind_speed_mps"),
        round_to(units.mps_to_mph(mps), 2).alias("wind_speed_mph"),
        round_to(units.pascal_to_millibar(_number("barometric_pressure_Pa")), 2).alias("pressure_mb"),
        F.lit(None).cast("string").alias("condition"),
    )


def with_load_time(staged: DataFrame) -> DataFrame:
    """Add the time of the load; call it when writing, a view would show the time of the query."""
    return staged.withColumn("ingestion_timestamp", F.current_timestamp())


def union_sources(*staged: DataFrame) -> DataFrame:
    """All rows of several staged sources, matched by column name."""
    first, *others = staged
    for other in others:
        first = first.unionByName(other)
    return first
