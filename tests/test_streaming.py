"""Streams: each file once, exact rollups, late rows and redelivery."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.stage import stage_path
from gaugeline.plans import marts
from gaugeline.streaming import dedup, ingest, rollup

SCHEMA = (
    "id long, station_id string, location string, observation_timestamp timestamp, "
    "temperature_degC double, humidity_pct double, wind_speed_mps double, pressure_mb double"
)
START = dt.datetime(2024, 1, 1)


def observations(spark, first, n, hours=1.0):
    rows = [
        (i, f"S{i % 3}", "L", START + dt.timedelta(hours=hours * i), i / 4, 50.0, None if i % 5 == 0 else 1.25, 1000.5)
        for i in range(first, first + n)
    ]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


@pytest.fixture
def paths(spark):
    return {name: stage_path(spark, name) for name in ("landed", "target", "checkpoint")}


def stream(spark, paths, **options):
    schema = observations(spark, 0, 1).schema
    return ingest.file_stream(spark, paths["landed"], schema, **options)


def land(df, paths):
    df.write.mode("append").parquet(paths["landed"])


def as_rows(df):
    return sorted(map(str, df.collect()))


def batch_daily(spark, df):
    return marts.daily_weather(marts.with_time_parts(df))


def test_each_file_is_loaded_once(spark, paths):
    land(observations(spark, 0, 50), paths)
    ingest.append_stream(stream(spark, paths), paths["target"], paths["checkpoint"])
    ingest.append_stream(stream(spark, paths), paths["target"], paths["checkpoint"])
    assert spark.read.parquet(paths["target"]).count() == 50
    land(observations(spark, 50, 10), paths)
    ingest.append_stream(stream(spark, paths), paths["target"], paths["checkpoint"])
    assert spark.read.parquet(paths["target"]).count() == 60


def test_partials_equal_batch_in_any_order(spark, paths):
    pieces = [observations(spark, 300, 60), observations(spark, 0, 100), observations(spark, 100, 200)]
    for piece in pieces:
        land(piece, paths)
    source = marts.with_time_parts(stream(spark, paths, files_per_batch=1))
    rollup.land_partials(source, paths["target"], paths["checkpoint"])
    rollup.land_partials(source, paths["target"], paths["checkpoint"])
    # A day that was rolled up before gets more rows, weeks late.
    land(observations(spark, 1000, 1), paths)
    land(observations(spark, 5, 1), paths)
    rollup.land_partials(source, paths["target"], paths["checkpoint"])
    everything = spark.read.parquet(paths["landed"])
    assert as_rows(rollup.read_partials(spark, paths["target"])) == as_rows(batch_daily(spark, everything))


def test_windowed_equals_batch_and_updates_open_days(spark, paths):
    land(observations(spark, 0, 30), paths)
    rollup.land_windowed(stream(spark, paths), "2 days", paths["target"], paths["checkpoint"])
    land(observations(spark, 30, 30), paths)
    rollup.land_windowed(stream(spark, paths), "2 days", paths["target"], paths["checkpoint"])
    everything = observations(spark, 0, 60)
    assert as_rows(rollup.read_windowed(spark, paths["target"])) == as_rows(batch_daily(spark, everything))


def test_windowed_drops_rows_behind_the_watermark(spark, paths):
    land(observations(spark, 0, 30), paths)
    rollup.land_windowed(stream(spark, paths), "1 hour", paths["target"], paths["checkpoint"])
    land(observations(spark, 2000, 1), paths)
    rollup.land_windowed(stream(spark, paths), "1 hour", paths["target"], paths["checkpoint"])
    land(observations(spark, 3, 1), paths)
    late = rollup.land_windowed(stream(spark, paths), "1 hour", paths["target"], paths["checkpoint"])
    assert late == 1
    total = rollup.read_windowed(spark, paths["target"]).agg(F.sum("observation_count")).first()[0]
    assert total == 31


def test_merged_batches_read_the_same(spark, paths):
    def folders():
        return sorted(f for f in os.listdir(paths["target"].removeprefix("file:")))

    for first in (0, 40, 80):
        land(observations(spark, first, 40), paths)
        rollup.land_partials(marts.with_time_parts(stream(spark, paths)), paths["target"], paths["checkpoint"])
        if first == 40:
            rollup.merge_batches(spark, paths["target"])
            assert folders() == ["batch-0", "batch-1", "upto-1"]
    expected = as_rows(batch_daily(spark, observations(spark, 0, 120)))
    assert as_rows(rollup.read_partials(spark, paths["target"])) == expected
    rollup.merge_batches(spark, paths["target"])
    assert as_rows(rollup.read_partials(spark, paths["target"])) == expected
    rollup.merge_batches(spark, paths["target"])
    assert folders() == ["upto-2"]
    assert as_rows(rollup.read_partials(spark, paths["target"])) == expected


def test_redelivered_rows_are_dropped_across_runs(spark, paths):
    first = observations(spark, 0, 40)
    land(first.unionByName(first.filter("id < 10")), paths)

    def run():
        kept = dedup.first_deliveries(stream(spark, paths), ["id"], "observation_timestamp", "3 days")
        ingest.append_stream(kept, paths["target"], paths["checkpoint"])
        return spark.read.parquet(paths["target"])

    assert run().count() == 40
    land(first.filter("id > 30"), paths)
    got = run()
    assert got.count() == 40
    land(observations(spark, 40, 5), paths)
    assert sorted(r["id"] for r in run().collect()) == list(range(45))
