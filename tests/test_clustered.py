"""Clustered tables: what a scan of a key reads, and what a rollup exchanges."""

from __future__ import annotations

import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import adapter
from gaugeline.operators.stage import stage
from gaugeline.plans import marts
from gaugeline.sources import clustered, tables


@pytest.fixture(scope="module")
def rows(spark, tiny_dir):
    """Fourteen stations of about 60 rows, and a hot one with half of all rows."""
    staged = adapter.staged(spark, tiny_dir)
    hot = F.when(F.col("event_id") % 2 == 0, "HOT").otherwise(F.col("station_id"))
    return stage(staged.withColumn("station_id", F.when(F.col("event_id") % 50 > 0, hot)), "rows")


@pytest.fixture
def table(spark, rows, tmp_path):
    namespace = f"obs_{uuid.uuid4().hex}"
    tables.create_namespace(spark, namespace, str(tmp_path))
    name = f"{namespace}.observations"
    clustered.save_clustered(
        rows, name, str(tmp_path / "t"), "station_id", "observation_timestamp", hot_rows=200, bucket_rows=120
    )
    yield name
    clustered.drop_clustered(spark, name)
    tables.drop_namespace(spark, namespace)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_all_rows_are_there_once(spark, rows, table):
    assert as_rows(clustered.read_clustered(spark, table)) == as_rows(rows)
    held = [{r[0] for r in spark.table(t).select("station_id").distinct().collect()} for t in (table, f"{table}_hot")]
    assert held[1] == {"HOT"} and "HOT" not in held[0] and None in held[0]


def test_a_key_reads_one_bucket(spark, rows, table, tmp_path):
    expected = as_rows(rows.filter("station_id = 'ST7'"))
    found = clustered.read_key(spark, table, "station_id", "ST7")
    assert as_rows(found) == expected
    assert "EqualTo(station_id,ST7)" in plan_of(found)
    cold = spark.table(table).filter("station_id = 'ST7'")
    [held] = {r[0] for r in cold.select("_metadata.file_name").distinct().collect()}
    # Files of other buckets that nobody could read.
    for file in (tmp_path / "t" / "cold").glob("*.parquet"):
        if file.name != held:
            file.write_bytes(b"no Parquet")
    assert as_rows(clustered.read_key(spark, table, "station_id", "ST7")) == expected


def test_rollups_by_key_exchange_nothing_but_hot_keys(spark, rows, table):
    expected = as_rows(marts.station_dimension(rows))
    assert as_rows(clustered.by_key(spark, table, marts.station_dimension)) == expected
    assert "Exchange" not in plan_of(marts.station_dimension(spark.table(table)))
    assert "Exchange" in plan_of(marts.station_dimension(spark.table(f"{table}_hot")))


def test_files_are_sorted_and_filtered(spark, table, tmp_path):
    files = sorted(Path(tmp_path / "t" / "cold").glob("*.parquet"))
    assert 1 < len(files) <= 9
    for file in files:
        held = pq.read_table(file).select(["station_id", "observation_timestamp"]).to_pylist()
        order = [(r["station_id"] is not None, r["station_id"] or "", r["observation_timestamp"]) for r in held]
        assert order == sorted(order)
    hot = [pq.read_table(f).num_rows for f in Path(tmp_path / "t" / "hot").glob("*.parquet")]
    assert max(hot) < 200 and sum(hot) > 400


def test_empty(spark, rows, tmp_path):
    namespace = f"obs_{uuid.uuid4().hex}"
    tables.create_namespace(spark, namespace, str(tmp_path))
    name = f"{namespace}.none"
    clustered.save_clustered(rows.limit(0), name, str(tmp_path / "t"), "station_id", "observation_timestamp")
    assert clustered.read_clustered(spark, name).count() == 0
    assert clustered.by_key(spark, name, marts.station_dimension).count() == 0
    tables.drop_namespace(spark, namespace)
