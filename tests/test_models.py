"""Staging and marts on hand-worked rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.zscore import CATEGORIES
from gaugeline.plans import marts, staging
from gaugeline.schemas import IMPERIAL_RAW, METRIC_RAW

SUNDAY = dt.datetime(2024, 1, 7, 23, 59, 59)
MIDNIGHT = dt.datetime(2024, 1, 8)
MORNING = dt.datetime(2024, 1, 8, 5)

ROWS = [
    ("A", "X", SUNDAY, 72.5, 40.0, 10.0, 1000.0, "clear"),
    ("A", "X", MIDNIGHT, 32.0, 50.0, 0.0, 1001.0, "clear"),
    ("A", "X", MIDNIGHT, -40.0, 60.0, 5.0, 1002.0, "snow"),
    ("B", "Y", MORNING, None, 70.0, None, 1003.0, None),
    ("C", "Y", MORNING, 50.0, 80.0, 1.0, 1004.0, None),
    ("D", "Z", None, 60.0, 10.0, 1.0, 1005.0, None),
    (None, "Z", MORNING, 60.0, 10.0, 1.0, 1006.0, None),
]


@pytest.fixture(scope="module")
def staged(spark):
    return staging.from_imperial(spark.createDataFrame(ROWS, IMPERIAL_RAW))


def test_staging(staged):
    got = {(r["station_id"], r["temperature_f"]): r for r in staged.collect()}
    assert len(got) == 6
    assert got["A", 72.5]["temperature_degC"] == 22.5
    assert got["A", 72.5]["wind_speed_mps"] == 4.47
    assert got["A", -40.0]["temperature_degC"] == -40.0
    assert got["A", -40.0]["wind_speed_mps"] == 2.24
    assert got["B", None]["temperature_degC"] is None
    assert ("D", 60.0) not in got
    assert staged.columns == staging.STAGED_COLUMNS


def test_staging_turns_nan_into_null(spark):
    row = ("A", "X", MIDNIGHT, float("nan"), 1.0, float("nan"), 1.0, None)
    got = staging.from_imperial(spark.createDataFrame([row], IMPERIAL_RAW)).first()
    assert got["temperature_degC"] is None and got["wind_speed_mps"] is None


def test_metric_staging_has_the_same_layout(spark, staged):
    values = {name: None for name in METRIC_RAW.names} | {
        "observation_timestamp": MIDNIGHT,
        "observation_id": "o1",
        "station_id": "K",
        "station_name": "Somewhere",
        "temperature_degC": 22.5,
        "wind_speed_kmh": 36.0,
        "barometric_pressure_Pa": 101325.0,
        "relative_humidity_percent": 55.0,
    }
    raw = spark.createDataFrame([tuple(values[n] for n in METRIC_RAW.names)], METRIC_RAW)
    metric = staging.from_metric(raw)
    row = metric.first()
    assert (row["temperature_f"], row["wind_speed_mps"], row["wind_speed_mph"]) == (72.5, 10.0, 22.37)
    assert (row["pressure_mb"], row["humidity_pct"], row["condition"]) == (1013.25, 55.0, None)
    assert metric.dtypes == staged.dtypes
    assert staging.union_sources(staged, metric).count() == 7


def test_view_stages_like_the_function(spark):
    rows = spark.createDataFrame(ROWS + [("E", "X", MIDNIGHT, float("nan"), 1.0, float("inf"), 1.0, None)], IMPERIAL_RAW)
    rows.createOrReplaceTempView("raw_rows")
    view = spark.sql(staging.imperial_view("raw_rows")).drop("ingestion_timestamp")
    assert view.dtypes == staging.from_imperial(rows).dtypes
    assert sorted(map(str, view.collect())) == sorted(map(str, staging.from_imperial(rows).collect()))


def test_averages_of_many_decimals(spark):
    rows = [("A", "X", MORNING, 50.0, h, 1.0, 1000.0, None) for h in (1.004, 1.004, 1.004, 1.008, 1.008)]
    daily = marts.daily_weather(marts.with_time_parts(staging.from_imperial(spark.createDataFrame(rows, IMPERIAL_RAW))))
    assert daily.first()["avg_humidity_pct"] == 1.01


def test_load_time_is_added(staged):
    assert staging.with_load_time(staged).columns[-1] == "ingestion_timestamp"


def test_fact_numbers_rows_in_time_order(staged):
    rows = marts.fact_observations(staged, ["temperature_f"]).orderBy("observation_id").collect()
    assert [r["observation_id"] for r in rows] == [1, 2, 3, 4, 5, 6]
    first, tie_low, tie_high = rows[:3]
    assert (first["observation_hour"], first["day_of_week"]) == (23, 0)
    assert (tie_low["temperature_f"], tie_high["temperature_f"]) == (-40.0, 32.0)
    assert (tie_low["observation_hour"], tie_low["day_of_week"]) == (0, 1)
    assert first["observation_date"] == dt.datetime(2024, 1, 7)


def test_default_tie_breakers_are_reproducible(staged):
    once = marts.fact_observations(staged).collect()
    again = marts.fact_observations(staged.repartition(5)).collect()
    assert sorted(map(str, once)) == sorted(map(str, again))


def test_daily(staged):
    days = {(r["station_id"], r["observation_date"].day): r for r in marts.daily_weather(marts.with_time_parts(staged)).collect()}
    assert sum(r["observation_count"] for r in days.values()) == 6
    busy = days["A", 8]
    assert (busy["min_temperature_degC"], busy["avg_temperature_degC"], busy["max_temperature_degC"]) == (-40.0, -20.0, 0.0)
    assert busy["max_wind_speed_mps"] == 2.24 and busy["avg_pressure_mb"] == 1001.5
    assert days["B", 8]["observation_count"] == 1 and days["B", 8]["avg_temperature_degC"] is None


def test_dimension(staged):
    stations = {r["station_id"]: r for r in marts.station_dimension(staged).collect()}
    assert set(stations) == {"A", "B", "C"}
    assert stations["A"]["total_observations"] == 3
    assert (stations["A"]["first_observation"], stations["A"]["last_observation"]) == (SUNDAY, MIDNIGHT)


def scored(spark, **series):
    rows = [
        (i, key, dt.datetime(2024, 1, 1), value)
        for key, values in series.items()
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "observation_id long, station_id string, observation_timestamp timestamp, temperature_degC double"
    )


def test_zscore_cases(spark):
    rows = scored(
        spark,
        flat=[0.0, 0.0, 0.0],
        edge=[-1.0, 0.0, 1.0],
        unusual=[0.0] * 4 + [10.0],
        extreme=[0.0] * 9 + [10.0],
        single=[5.0],
        gap=[0.0] * 4 + [10.0, None],
    )
    events = {r["station_id"]: r for r in marts.extreme_events(rows).collect()}
    assert set(events) == {"unusual", "extreme", "gap"}
    assert events["unusual"]["temp_z_score"] == pytest.approx(1.788854, abs=1e-6)
    assert events["unusual"]["temperature_category"] == "Unusual"
    assert events["extreme"]["temp_z_score"] == pytest.approx(2.846050, abs=1e-6)
    assert events["extreme"]["temperature_category"] == "Extreme"
    classified = marts.classify(rows)
    assert classified.count() == rows.count()
    by_station = classified.filter(F.col("station_id").isin("flat", "edge", "single"))
    assert {r[0] for r in by_station.select("temperature_category").collect()} == {"Normal"}
    assert {r[0] for r in classified.select("temperature_category").collect()} <= set(CATEGORIES)
