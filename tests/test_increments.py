"""Pieces that merge, marts refreshed by what was landed, numbers that stay, sketches."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from checks import adapter
from checks.queries import _kept, _landings, _new_table
from gaugeline.operators import sketches, spread
from gaugeline.operators.stage import stage, stage_path
from gaugeline.operators.zscore import group_spread
from gaugeline.plans import marts, refresh
from gaugeline.sources import tables

VALUES = "station string, day int, value double"


def pieces_of(spark, rows, keys=("station", "day")):
    return stage(spread.spread_pieces(spark.createDataFrame(rows, VALUES), list(keys), "value"), "pieces")


def test_spread_of_merged_pieces(spark):
    rng = random.Random(2)
    # Means a billion times their deviation: sums of squares would have no digit left.
    rows = [(s, rng.randrange(30), 1e9 * (s == "far") + rng.gauss(0, 1)) for s in ("near", "far") for _ in range(500)]
    merged = spread.finished_spread(spread.merge_spread(pieces_of(spark, rows), ["station"]))
    for row in merged.collect():
        held = [v for s, _, v in rows if s == row["station"]]
        assert row["avg_temp"] == pytest.approx(math.fsum(held) / len(held), rel=1e-15)
        assert row["stddev_temp"] == pytest.approx(statistics.stdev(held), rel=1e-6)


def test_spread_merges_in_any_order(spark):
    """Days to weeks to all gives what days to all gives, and what the batch gives."""
    rng = random.Random(4)
    rows = [(f"S{i % 3}", rng.randrange(28), rng.gauss(15, 9)) for i in range(2000)]
    days = pieces_of(spark, rows)
    weeks = stage(
        spread.merge_spread(days.withColumn("week", F.floor(F.col("day") / 7)), ["station", "week"]), "weeks"
    )
    batch = group_spread(spark.createDataFrame(rows, VALUES), "station", "value")

    def plain(df):
        return sorted((r["station"], round(r["avg_temp"], 9), round(r["stddev_temp"], 9)) for r in df.collect())

    assert plain(spread.finished_spread(spread.merge_spread(days, ["station"]))) == plain(batch)
    assert plain(spread.finished_spread(spread.merge_spread(weeks, ["station"]))) == plain(batch)


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([None], (None, None)),
        ([None, 3.0], (3.0, None)),
        ([0.1] * 7, (0.1, 0.0)),
        ([1.0, None, 3.0], (2.0, math.sqrt(2))),
    ],
)
def test_spread_of_hard_groups(spark, values, expected):
    rows = [(None, i, v) for i, v in enumerate(values)]
    [row] = spread.finished_spread(spread.merge_spread(pieces_of(spark, rows), ["station"])).collect()
    assert row["station"] is None and row["avg_temp"] == expected[0]
    assert row["stddev_temp"] == (None if expected[1] is None else pytest.approx(expected[1]))


def test_spread_of_nothing(spark):
    assert spread.merge_spread(pieces_of(spark, []), ["station"]).collect() == []


@pytest.fixture(scope="module")
def rows(spark, tiny_dir):
    return stage(adapter.staged(spark, tiny_dir), "observations")


@pytest.fixture
def daily_tables(spark, rows):
    dated = refresh.with_day(marts.with_time_parts(rows))
    namespace, name = _new_table(spark, dated, ("day",))
    mart = f"{namespace}.daily"
    model = refresh.with_day(marts.daily_weather(dated.limit(0)), "observation_date")
    tables.create_table(spark, mart, model.schema, stage_path(spark, "mart"), ("day",))
    yield dated, name, mart
    tables.drop_namespace(spark, namespace)


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_refresh_reads_and_writes_touched_days_only(spark, daily_tables):
    dated, name, mart = daily_tables
    first = dated.filter("event_id % 3 > 0")
    tables.append_rows(first, name)
    assert len(refresh.refresh_daily(spark, name, mart, first)) > 5
    before = {r[0]: r[1] for r in _files(tables.read_table(spark, mart))}
    late = dated.filter("event_id % 3 = 0 AND day IN (DATE'2024-01-03', DATE'2024-01-05')")
    tables.append_rows(late, name)
    # A day that is not touched holds rows that no reader could stand.
    broken = dated.filter("day = DATE'2024-01-04'").limit(1).withColumn("temperature_degC", F.lit(1e300))
    tables.append_rows(broken, name)
    days = refresh.refresh_daily(spark, name, mart, late)
    assert [str(d) for d in days] == ["2024-01-03", "2024-01-05"]
    after = {r[0]: r[1] for r in _files(tables.read_table(spark, mart))}
    assert {str(d) for d in after if after[d] != before.get(d)} == {"2024-01-03", "2024-01-05"}
    expected = marts.daily_weather(first.unionByName(late))
    assert as_rows(tables.read_table(spark, mart).drop("day").select(*expected.columns)) == as_rows(expected)


def _files(df):
    return df.groupBy("day").agg(F.sort_array(F.collect_set("_metadata.file_path"))).collect()


def test_refresh_again_changes_nothing(spark, daily_tables):
    dated, name, mart = daily_tables
    tables.append_rows(dated, name)
    refresh.refresh_daily(spark, name, mart, dated)
    once = as_rows(tables.read_table(spark, mart))
    refresh.refresh_daily(spark, name, mart, dated.filter("event_id < 100"))
    assert as_rows(tables.read_table(spark, mart)) == once
    assert refresh.refresh_daily(spark, name, mart, dated.limit(0)) == []


def test_untouched_days_are_pruned(spark, daily_tables):
    dated, name, _ = daily_tables
    tables.append_rows(dated, name)
    days = refresh.touched_days(dated.filter("event_id < 3"))
    plan = refresh.of_days(tables.read_table(spark, name), days)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day#" in text or "PartitionFilters: [day#" in text
    assert plan.select("day").distinct().count() == len(days)


@pytest.fixture
def fact_table(spark, rows):
    model = refresh.with_day(marts.fact_observations(rows.limit(0), ["event_id"], keep=("event_id",)))
    namespace, name = _new_table(spark, model, ("day",))
    yield name
    tables.drop_namespace(spark, namespace)


def numbers(spark, name):
    return {r["event_id"]: r["observation_id"] for r in tables.read_table(spark, name).collect()}


def test_numbers_stay_and_are_dense(spark, rows, fact_table):
    held: dict = {}
    for landing in _landings(rows):
        refresh.fact_increment(spark, fact_table, landing, ["event_id"])
        now = numbers(spark, fact_table)
        assert sorted(now.values()) == list(range(1, len(now) + 1))
        assert {k: now[k] for k in held} == held
        held = now
    # The same rows again, and twice in one landing, add none.
    again = rows.filter("event_id % 2 = 0")
    assert refresh.fact_increment(spark, fact_table, again.unionByName(again), ["event_id"]).count() == 0
    assert numbers(spark, fact_table) == held


def test_highest_number_comes_from_footers(spark, rows, fact_table):
    assert refresh.high_mark(spark, fact_table, "observation_id") == 0
    refresh.fact_increment(spark, fact_table, rows, ["event_id"])
    assert refresh.high_mark(spark, fact_table, "observation_id") == rows.count()
    plan = tables.table_footers(spark, fact_table).agg(F.max("observation_id"))
    assert "PushedAggregation: [MAX(observation_id)]" in plan._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_of_united_sketches(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 10).alias("day"), (F.col("id") % 2).alias("half"), F.concat(F.lit("s"), F.col("id") % 20_011).alias("s")
    )
    united = sketches.united_sketches(sketches.distinct_sketches(df, ["half", "day"], "s"), ["half"])
    for row in united.select("n_rows", sketches.distinct_estimate(F.col("sketch")).alias("n")).collect():
        assert row["n_rows"] == 30_000
        assert abs(row["n"] - 20_011) <= sketches.distinct_error() * 20_011


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, None), ("b", None, float("nan"))], "g string, s string, v double")
    found = sketches.united_sketches(sketches.distinct_sketches(df.filter("g = 'a'"), ["g"], "s"), ["g"])
    assert [r[0] for r in found.select(sketches.distinct_estimate(F.col("sketch"))).collect()] == [0]
    merged = sketches.merged_quantiles(sketches.quantile_sketches(df, ["g"], ["v"]), ["g"])
    assert [r[0] for r in merged.select(sketches.sketched_percentile("v", 0.5)).collect()] == [None, None]


def test_rank_error_of_merged_quantiles(spark):
    """Half a million values in 50 sketches: far above what a sketch keeps."""
    n = 500_000
    df = spark.range(n).select((F.col("id") % 50).alias("day"), ((F.col("id") * 7919) % n).cast("double").alias("v"))
    merged = sketches.merged_quantiles(sketches.quantile_sketches(df, ["day"], ["v"]), [])
    shares = [0.01, 0.25, 0.5, 0.95, 0.999]
    [row] = merged.select(*(sketches.sketched_percentile("v", p) for p in shares)).collect()
    for p, value in zip(shares, row):
        assert abs(value / n - p) <= 1.5 * sketches.rank_error()


def test_quantile_sketches_take_one_pass(spark, tiny_dir):
    df = adapter.charged(spark, tiny_dir)
    plan = sketches.quantile_sketches(df, ["l_suppkey"], ["charge"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan and "unpivot" not in plan.lower()
