"""Schemas of landed documents and tables; column and field names are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# Measure columns of an observation and the document field each comes from.
MEASURES = {
    "temperature_degC": "temperature",
    "dewpoint_degC": "dewpoint",
    "wind_direction_deg": "windDirection",
    "wind_speed_kmh": "windSpeed",
    "wind_gust_kmh": "windGust",
    "barometric_pressure_Pa": "barometricPressure",
    "sea_level_pressure_Pa": "seaLevelPressure",
    "visibility_m": "visibility",
    "max_temp_24h_degC": "maxTemperatureLast24Hours",
    "min_temp_24h_degC": "minTemperatureLast24Hours",
    "precipitation_3h_mm": "precipitationLast3Hours",
    "relative_humidity_percent": "relativeHumidity",
    "wind_chill_degC": "windChill",
    "heat_index_degC": "heatIndex",
}

# Fixed values from here on: the layouts of raw tables and landed documents.
METRIC_RAW = T.StructType(
    [
        T.StructField("observation_timestamp", T.TimestampType(), False),
        T.StructField("observation_id", T.StringType(), False),
        T.StructField("observation_type", T.StringType()),
        T.StructField("geometry_type", T.StringType()),
        T.StructField("geometry_coordinates", T.ArrayType(T.StringType())),
        T.StructField("elevation_m", T.DoubleType()),
        T.StructField("station_id", T.StringType(), False),
        T.StructField("station_name", T.StringType()),
        *(T.StructField(name, T.DoubleType()) for name in MEASURES),
    ]
)

IMPERIAL_RAW = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("observation_time", T.TimestampType()),
        T.StructField("temperature_f", T.DoubleType()),
        T.StructField("humidity_pct", T.DoubleType()),
        T.StructField("wind_speed_mph", T.DoubleType()),
        T.StructField("pressure_mb", T.DoubleType()),
        T.StructField("condition", T.StringType()),
    ]
)

# ``page`` is the address a page was fetched from, where whoever landed it noted that.
STATION_PAGE = T.StructType(
    [
        T.StructField("page", T.StringType()),
        T.StructField("observationStations", T.ArrayType(T.StringType())),
        T.StructField("pagination", T.StructType([T.StructField("next", T.StringType())])),
    ]
)

# Readings stay text until the contract casts them, so that a bad one is seen.
_reading = T.StructType([T.StructField("value", T.StringType())])

FEATURE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("timestamp", T.StringType()),
                    T.StructField("stationId", T.StringType()),
                    T.StructField("stationName", T.StringType()),
                    T.StructField("elevation", _reading),
                    *(T.StructField(source, _reading) for source in MEASURES.values()),
                ]
            ),
        ),
    ]
)

FEATURE_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])

SAMPLES = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)
