"""The plans behind the queries: pushdown, shuffles, broadcasts, generated code."""

from __future__ import annotations

import re

import pytest

from bench import HEADLINE, OBSERVATIONS, wide_rows
from checks.adapter import staged, table
from checks.queries import QUERIES
from gaugeline.operators import stage as staging
from gaugeline.operators.zscore import with_zscore
from gaugeline.plans import analytics, marts

# HotSpot interprets larger methods instead of compiling them.
COMPILED_BYTES = 8000


def explained(df, capsys, mode="simple") -> str:
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def exchanges(plan: str) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", plan)


def scan_columns(plan: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_filters_reach_the_scan(spark, tiny_dir, capsys):
    plan = explained(QUERIES["filtered_scan"](spark, tiny_dir), capsys)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    for part in ("EqualTo(event_type,view)", "GreaterThanOrEqual(ts", "LessThan(ts"):
        assert part in pushed
    assert exchanges(plan) == []


def test_count_comes_from_footers(spark, tiny_dir, capsys):
    plan = explained(QUERIES["count_star"](spark, tiny_dir), capsys, "formatted")
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_daily_aggregation_shuffles_once_and_prunes(spark, tiny_dir, capsys):
    plan = explained(QUERIES["daily_aggregation"](spark, tiny_dir), capsys)
    assert exchanges(plan) == ["hashpartitioning"]
    assert plan.count("HashAggregate") == 2
    assert scan_columns(plan) == [
        {"l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"}
    ]


def test_daily_model_needs_no_numbering(spark, tiny_dir, capsys):
    plan = explained(QUERIES["daily_weather"](spark, tiny_dir), capsys)
    assert exchanges(plan) == ["hashpartitioning"] and "Window" not in plan


def test_zscore_broadcasts_groups_and_leaves_rows_in_place(spark, tiny_dir, capsys):
    plan = explained(QUERIES["anomaly_detection"](spark, tiny_dir), capsys)
    assert "BroadcastHashJoin" in plan
    # The only shuffle belongs to the aggregate below the broadcast.
    assert exchanges(plan) == ["hashpartitioning"]


def test_zscore_of_many_groups_falls_back_to_a_shuffle(spark, tiny_dir, capsys, monkeypatch):
    rows = staged(spark, tiny_dir)
    expected = sorted(map(str, with_zscore(rows, "station_id", "temperature_degC").collect()))
    monkeypatch.setattr(staging, "SMALL_BYTES", 0)
    settled = with_zscore(rows, "station_id", "temperature_degC")
    assert "gaugeline" in explained(settled, capsys) and settled.count() == len(expected)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = with_zscore(rows, "station_id", "temperature_degC")
        assert "SortMergeJoin" in explained(shuffled, capsys)
        assert sorted(map(str, shuffled.collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_brings_only_slot_counts_together(spark, tiny_dir, capsys):
    plan = explained(QUERIES["fact_observations"](spark, tiny_dir), capsys)
    details = re.findall(r"row_number\(\).*?ROWS|Window \[row_number\(\) windowspecdefinition\((\w+)", plan)
    assert any("_slot" in d for d in details)
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[" in lines[at + 1] and "_slot" in lines[at + 1]
    assert exchanges(plan).count("SinglePartition") == 1


def test_latest_keeps_a_few_rows_per_task(spark, tiny_dir, capsys):
    plan = explained(QUERIES["latest_observations"](spark, tiny_dir), capsys)
    assert "TakeOrderedAndProject" in plan and exchanges(plan) == []


def test_percentiles_keep_no_values_in_memory(spark, tiny_dir, capsys):
    plan = explained(QUERIES["monthly_percentiles"](spark, tiny_dir), capsys)
    # Counted values are staged; windows over them sort, and spill if they must.
    assert "percentile" not in plan and "collect" not in plan and "Window" in plan


def test_rolling_average_shuffles_by_station(spark, tiny_dir, capsys):
    plan = explained(QUERIES["rolling_avg"](spark, tiny_dir), capsys)
    assert exchanges(plan) == ["hashpartitioning"]


def test_station_filter_of_the_rolling_average_is_pushed(spark, tiny_dir, capsys):
    lineitem = table(spark, tiny_dir, "lineitem")
    df = analytics.rolling_24(
        lineitem, [1, 2], key="l_suppkey", time="l_shipdate", value="l_quantity", tie=("l_orderkey",)
    )
    assert "In(l_suppkey, [1,2])" in explained(df, capsys)


def test_partitioned_table_is_pruned(spark, capsys, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id % 3 AS day").write.partitionBy("day").parquet(path)
    plan = explained(spark.read.parquet(path).filter("day = 1"), capsys)
    assert re.search(r"PartitionFilters: \[.*day", plan)


@pytest.mark.parametrize(
    "name", [n for n in sorted(QUERIES) if not n.startswith("stream")]
)
def test_no_python_and_no_cross_joins(spark, tiny_dir, capsys, name):
    plan = explained(QUERIES[name](spark, tiny_dir), capsys)
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


@pytest.fixture(scope="module")
def without_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def largest_method(df, capsys) -> int:
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", explained(df, capsys, "codegen"))), default=0)


@pytest.mark.parametrize("name", HEADLINE)
def test_generated_code_is_compiled(spark, without_aqe, tiny_dir, capsys, name):
    assert largest_method(QUERIES[name](spark, tiny_dir), capsys) < COMPILED_BYTES


def test_generated_code_on_wide_rows_is_compiled(spark, without_aqe, tiny_dir, capsys):
    rows = wide_rows(spark, tiny_dir)
    assert len(rows.columns) == 22
    observations = staging.stage(rows, "plan")
    for query in OBSERVATIONS.values():
        assert largest_method(query(observations), capsys) < COMPILED_BYTES


def test_marts_read_what_they_need(spark, tiny_dir, capsys):
    plan = explained(marts.station_dimension(staged(spark, tiny_dir)), capsys)
    assert scan_columns(plan) == [{"event_id", "ts", "user_id"}]
