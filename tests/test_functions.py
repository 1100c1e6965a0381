"""Rounding, sums, units, time parts and URL keys."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.functions import text, timeparts, units
from gaugeline.functions.rounding import round_average, round_to, steady_avg


def one(spark, column, value, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("value", "places", "expected"),
    [
        (1.005, 2, 1.0),
        (2.675, 2, 2.68),
        (0.285, 2, 0.28),
        (-2.5, 0, -3.0),
        (2.5, 0, 3.0),
        (0.49999999999999994, 0, 0.0),
        (2.4999999999999996, 0, 2.0),
        (1e300, 2, 1e300),
        (math.inf, 2, math.inf),
        (None, 2, None),
    ],
)
def test_round_to(spark, value, places, expected):
    assert one(spark, lambda x: round_to(x, places), value) == expected


def test_round_keeps_nan(spark):
    assert math.isnan(one(spark, lambda x: round_to(x, 2), math.nan))


def test_round_equals_sql_rounding(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate(
        [
            rng.normal(0, 100, 2000),
            rng.integers(-(10**6), 10**6, 2000) / 1000,
            rng.integers(-(10**4), 10**4, 2000) / 8,
            rng.normal(0, 1e12, 200),
        ]
    ).tolist()
    rows = spark.createDataFrame(list(enumerate(values)), "i long, x double").coalesce(1)
    got = [r[0] for r in rows.select("i", "x", round_to(F.col("x"), 2).alias("r")).orderBy("i").select("r").collect()]
    listed = ", ".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(values))
    expected = duckdb.sql(f"SELECT ROUND(x, 2) FROM (VALUES {listed}) t(i, x) ORDER BY i").fetchall()
    assert got == [e[0] for e in expected]


def average(rows, parts=1):
    return rows.repartition(parts).agg(steady_avg(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([22.222] * 3, 22.222),
        ([1.004] * 3 + [1.008] * 2, 1.0056),
        ([0.244, 0.244, 0.248], 0.24533333333333333),
        ([1e17, 2.0], 5e16),
        ([1e300, 1e300], 1e300),
        ([math.inf, 1.0], math.inf),
        ([None, 4.0], 4.0),
        ([None], None),
        ([1e-12, 3e-12], 2e-12),
    ],
)
def test_averages_keep_all_decimals(spark, values, expected):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    assert average(rows) == (None if expected is None else pytest.approx(expected, rel=1e-15))


def test_averages_of_nan(spark):
    assert math.isnan(average(spark.createDataFrame([(1.0,), (math.nan,)], "x double")))
    assert math.isnan(average(spark.createDataFrame([(math.inf,), (-math.inf,)], "x double")))


def test_averages_do_not_depend_on_order(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(20, 30, 3000), rng.normal(0, 1e6, 500), [1e9, -1e9, 1e-7]]).tolist()
    exact = math.fsum(values) / len(values)
    got = {average(spark.createDataFrame([(v,) for v in rng.permutation(values).tolist()], "x double"), p) for p in (1, 3, 7, 8)}
    assert got == {exact}


def test_halves_of_averages_round_as_decimals(spark):
    rows = spark.createDataFrame([(v,) for v in (-1.86, 13.12, 76.38, -10.66)], "x double")
    assert rows.agg(round_average(steady_avg(F.col("x")), 2)).first()[0] == 19.25
    rows = spark.createDataFrame([(v,) for v in (0.244, 0.244, 0.248)], "x double")
    assert rows.agg(round_average(steady_avg(F.col("x")), 2)).first()[0] == 0.25


def test_units(spark):
    assert one(spark, lambda x: round_to(units.fahrenheit_to_celsius(x), 2), 72.5) == 22.5
    assert one(spark, lambda x: round_to(units.mph_to_mps(x), 2), 10.0) == 4.47
    assert one(spark, units.celsius_to_fahrenheit, -40.0) == -40.0
    assert one(spark, units.mps_to_kmh, 10.0) == 36.0
    assert one(spark, units.kmh_to_mps, 36.0) == 10.0
    assert one(spark, lambda x: round_to(units.mps_to_mph(x), 2), 4.4704) == 10.0
    assert one(spark, units.pascal_to_millibar, 101325.0) == 1013.25


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_parts(spark, kind):
    rows = spark.createDataFrame([("2024-01-07 23:59:59",)], "t string").select(F.col("t").cast(kind))
    row = rows.select(
        timeparts.day_start(rows, "t").alias("day"),
        timeparts.hour_of(F.col("t")).alias("hour"),
        timeparts.day_of_week(F.col("t")).alias("dow"),
        timeparts.month_of(F.col("t")).alias("month"),
        timeparts.epoch_seconds(rows, "t").alias("seconds"),
        (F.col("t") >= timeparts.moment(rows, "t", "2024-01-07 23:59:59")).alias("reached"),
    )
    assert dict(row.dtypes)["day"] == kind
    assert row.select(F.col("day").cast("string"), "hour", "dow", "month", "seconds", "reached").first()[
        :
    ] == ("2024-01-07 00:00:00", 23, 0, 1, 19729 * 86400 + 86399, True)


def test_epoch_seconds_before_1970_and_in_a_skipped_hour(spark):
    moments = [
        dt.datetime(1969, 12, 31, 23, 59, 58, 500_000),
        dt.datetime(2024, 3, 10, 1, 59),
        dt.datetime(2024, 3, 10, 2, 30),
        dt.datetime(2024, 3, 10, 3, 0),
    ]
    rows = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in rows.orderBy("t").select(timeparts.epoch_seconds(rows, "t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == -2 and [b - a for a, b in zip(got[1:], got[2:])] == [31 * 60, 30 * 60]


def test_text_keys(spark):
    page = "https://host/stations?limit=500&cursor=abc"
    assert one(spark, text.after_marker, page, "string") == "abc"
    assert one(spark, text.after_marker, "https://host/stations", "string") == "https://host/stations"
    assert one(spark, text.last_segment, "https://host/stations/KJFK", "string") == "KJFK"
