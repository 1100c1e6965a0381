"""Numbering, rolling averages and order statistics against brute force, on both paths."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import mutate, order_stats, ordering
from gaugeline.operators.order_stats import grouped_order_stats, nearest_rank, percentile_cont
from gaugeline.operators.ordering import (
    global_position,
    number_rows,
    rank_hot,
    running_total,
)
from gaugeline.operators.rolling import rolling_average
from gaugeline.operators.skew import null_safe_join, split_hot

START = dt.datetime(2024, 1, 1)
ALL_COLD, ALL_HOT, MIXED = 10**6, 1, 40


@pytest.fixture(autouse=True)
def several_sort_tasks(monkeypatch):
    """Small enough that a range sort of the test rows takes several tasks."""
    monkeypatch.setattr(ordering, "SORT_ROWS", 60)


@pytest.fixture(scope="module")
def series(spark):
    """A third of the rows share one station and one instant; some keys, times and values are NULL."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        station = "hot" if hot else rng.choice(["a", "b", "c", None])
        hour = 7 if hot else rng.randrange(100)
        ts = None if rng.random() < 0.03 else START + dt.timedelta(hours=hour, minutes=0 if hot else rng.randrange(3))
        value = None if rng.random() < 0.1 else round(rng.uniform(-30, 40), 2)
        rows.append((i, station, ts, value))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, station string, ts timestamp_ntz, value double")
    return df.repartition(7), rows


def ordered(rows):
    return sorted(rows, key=lambda r: (r[2] is None, r[2] or START, r[0]))


@pytest.mark.parametrize("hot_rows", [ALL_COLD, ALL_HOT, MIXED])
def test_number_rows(series, hot_rows):
    df, rows = series
    numbered = number_rows(df, "ts", ["id"], "n", hot_rows)
    got = {r["id"]: r["n"] for r in numbered.collect()}
    assert got == {r[0]: n for n, r in enumerate(ordered(rows), 1)}
    assert numbered.columns == [*df.columns, "n"]


def test_number_rows_is_dense_when_the_order_has_ties(series):
    df, rows = series
    got = sorted(r["n"] for r in number_rows(df, "ts", [], "n", ALL_HOT).collect())
    assert got == list(range(1, len(rows) + 1))


def test_a_stray_time_leaves_slots_as_they_are(spark, monkeypatch):
    """Times in one month and one far before: no slot grows, so nothing is sorted by range."""
    sorted_by_range = []
    monkeypatch.setattr(ordering, "rank_hot", lambda *args: sorted_by_range.append(args))
    times = [START + dt.timedelta(minutes=7 * i) for i in range(3000)] + [dt.datetime(1900, 1, 1)]
    df = spark.createDataFrame(list(enumerate(times)), "id long, ts timestamp_ntz").repartition(5)
    got = {r["id"]: r["n"] for r in number_rows(df, "ts", ["id"], "n", hot_rows=200).collect()}
    assert sorted_by_range == []
    assert got == {3000: 1} | {i: i + 2 for i in range(3000)}


def test_sort_tasks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_ROWS", 10)
    monkeypatch.setattr(ordering, "SORT_TASKS", 4)
    staged = ordering._sorted_stage(spark.range(1000).toDF("k"), ["k"])
    assert staged.select("_part").distinct().count() <= 4


def test_equal_keys_spread_over_sort_partitions(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_ROWS", 2_500)
    same = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    staged = ordering._sorted_stage(same, ["k"])
    sizes = [r["count"] for r in staged.groupBy("_part").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 9 and max(sizes) < 5_000


def test_positions_of_an_empty_table(spark):
    assert global_position(spark.range(0), ["id"]).count() == 0
    empty = spark.createDataFrame([], "id long, ts timestamp_ntz")
    assert number_rows(empty, "ts", ["id"]).count() == 0


def test_running_total(spark):
    rows = spark.range(1000).select(((F.col("id") * 7) % 1000).alias("k"), (F.col("id") % 5).alias("w"))
    got = running_total(rows, ["k"], "w", "total").orderBy("k").collect()
    total = 0
    for row in got:
        total += row["w"]
        assert row["total"] == total


def test_rank_hot_counts_from_one_in_every_group(series):
    df, rows = series
    got = {(r["station"], r["id"]): r["n"] for r in rank_hot(df, ["station"], ["id"], "n").collect()}
    for station in {r[1] for r in rows}:
        ids = sorted(r[0] for r in rows if r[1] == station)
        assert [got[station, i] for i in ids] == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("rows_in_frame", [1, 5, 24])
@pytest.mark.parametrize("hot_rows", [ALL_COLD, ALL_HOT, MIXED, 100])
def test_rolling_average(series, hot_rows, rows_in_frame):
    df, rows = series
    result = rolling_average(
        df, "station", ["ts", "id"], "value", "avg", rows=rows_in_frame, hot_rows=hot_rows
    )
    got = {r["id"]: r["avg"] for r in result.collect()}
    assert len(got) == len(rows)
    for station in {r[1] for r in rows}:
        mine = ordered([r for r in rows if r[1] == station])
        for at, row in enumerate(mine):
            frame = [r[3] for r in mine[max(0, at - rows_in_frame + 1) : at + 1] if r[3] is not None]
            if frame:
                assert got[row[0]] == pytest.approx(math.fsum(frame) / len(frame), rel=1e-14, abs=1e-14)
            else:
                assert got[row[0]] is None


def test_rolling_average_of_infinity_nan_and_many_decimals(spark):
    rng = random.Random(8)
    odd = {50: math.inf, 90: math.nan, 130: 1e17, 170: None}
    rows = [(i, "s", START + dt.timedelta(hours=i), odd.get(i, rng.uniform(-1, 1) / 3)) for i in range(260)]
    df = spark.createDataFrame(rows, "id long, station string, ts timestamp_ntz, value double").repartition(5)

    def rolled(hot_rows):
        got = rolling_average(df, "station", ["ts", "id"], "value", "avg", rows=24, hot_rows=hot_rows)
        return {r["id"]: repr(r["avg"]) for r in got.collect()}

    cold = rolled(ALL_COLD)
    assert cold == rolled(ALL_HOT) == rolled(MIXED)
    assert cold[50] == cold[73] == "inf" and cold[90] == cold[113] == "nan"
    assert float(cold[49]) == pytest.approx(math.fsum(r[3] for r in rows[26:50]) / 24, rel=1e-15)


@pytest.mark.parametrize("values", [ALL_COLD, ALL_HOT, MIXED])
def test_order_stats(series, values, monkeypatch):
    monkeypatch.setattr(order_stats, "WINDOW_VALUES", values)
    df, rows = series
    stats = {
        "p50": percentile_cont("value", 0.5),
        "p95": percentile_cont("value", 0.95),
        "rank": nearest_rank("value", 0.95),
        "id50": percentile_cont("id", 0.5),
    }
    result = grouped_order_stats(df, ["station"], stats, [F.count(F.lit(1)).alias("n")])
    got = {r["station"]: r for r in result.collect()}
    assert set(got) == {r[1] for r in rows}
    for station, row in got.items():
        mine = [r for r in rows if r[1] == station]
        values = sorted(r[3] for r in mine if r[3] is not None)
        assert row["n"] == len(mine)
        assert row["p50"] == pytest.approx(statistics.median(values))
        assert row["p95"] == pytest.approx(float(np.percentile(values, 95)))
        assert row["rank"] == values[min(int(len(values) * 0.95), len(values) - 1)]
        assert row["id50"] == pytest.approx(statistics.median([r[0] for r in mine]))


@pytest.mark.parametrize("copies", [1, 30])
@pytest.mark.parametrize("values", [ALL_COLD, ALL_HOT])
def test_order_stats_of_infinity_and_nan(spark, values, copies, monkeypatch):
    monkeypatch.setattr(order_stats, "WINDOW_VALUES", values)
    groups = {"inf": [1.0, 2.0, math.inf], "low": [-math.inf, 3.0, 4.0], "nan": [5.0, math.nan, 6.0]}
    rows = [(k, v) for k, vs in groups.items() for v in vs * copies]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    stats = {"top": percentile_cont("v", 1.0), "first": percentile_cont("v", 0.0), "rank": nearest_rank("v", 0.95)}
    got = {r["k"]: r for r in grouped_order_stats(df, ["k"], stats, []).collect()}
    assert (got["inf"]["top"], got["inf"]["first"], got["inf"]["rank"]) == (math.inf, 1.0, math.inf)
    assert (got["low"]["top"], got["low"]["first"], got["low"]["rank"]) == (4.0, -math.inf, 4.0)
    assert got["nan"]["first"] == 5.0 and math.isnan(got["nan"]["top"]) and math.isnan(got["nan"]["rank"])


@pytest.mark.parametrize("values", [ALL_COLD, ALL_HOT])
def test_order_stats_of_repeated_and_missing_values(spark, values, monkeypatch):
    monkeypatch.setattr(order_stats, "WINDOW_VALUES", values)
    rows = [("same", 3.0)] * 50 + [("same", 4.0)] + [("none", None)] * 3 + [("one", 7.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    stats = {"mid": percentile_cont("v", 0.5), "top": percentile_cont("v", 1.0)}
    got = {r["k"]: (r["mid"], r["top"]) for r in grouped_order_stats(df, ["k"], stats, []).collect()}
    assert got == {"same": (3.0, 4.0), "none": (None, None), "one": (7.0, 7.0)}


def test_split_hot_keeps_every_row(series):
    df, rows = series
    cold, hot = split_hot(df, ["station"], 150)
    assert {r[0] for r in hot.select("station").distinct().collect()} == {"hot"}
    assert cold.count() + hot.count() == len(rows)
    assert cold.filter("station IS NULL").count() == sum(r[1] is None for r in rows)
    assert split_hot(df, ["station"], ALL_COLD)[1] is None
    # Enough rows to look, but no group that is too large.
    assert split_hot(df, ["id"], 10)[1] is None


def test_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    joined = null_safe_join(left, right, ["k"], "inner")
    assert joined.columns == ["k", "x", "y"]
    assert {tuple(r) for r in joined.collect()} == {(None, 1, 10), ("a", 2, 20)}
    assert [r["k"] for r in null_safe_join(left, right, ["k"], "left_anti").collect()] == ["b"]


def test_update_reads_old_values_and_skips_null_predicates(spark):
    rows = spark.createDataFrame([(1, 2, True), (3, 4, False), (5, 6, None)], "a int, b int, c boolean")
    swapped = mutate.update_where(rows, {"a": F.col("b"), "b": F.col("a")}, F.col("c"))
    assert {tuple(r) for r in swapped.collect()} == {(2, 1, True), (3, 4, False), (5, 6, None)}
    assert swapped.dtypes == rows.dtypes


def test_delete_and_rest_partition_the_rows(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "a int, c boolean")
    kept = mutate.delete_where(rows, F.col("c"))
    assert {r["a"] for r in kept.collect()} == {2, 3}
    assert kept.count() + rows.filter("c").count() == rows.count()


def test_not_yet_landed(spark):
    incoming = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    landed = spark.createDataFrame([("a",), ("a",)], "k string")
    left = [r["k"] for r in mutate.not_yet_landed(incoming, landed, ["k"]).collect()]
    assert sorted(left, key=str) == [None, "b", "b"]
    again = landed.union(spark.createDataFrame([(None,)], "k string"))
    assert [r["k"] for r in mutate.not_yet_landed(incoming, again, ["k"]).collect()] == ["b", "b"]


def test_nearest_rank_of_few_runs_is_the_maximum(spark):
    rows = spark.createDataFrame([("q", float(v)) for v in (10, 11, 12, 13, 14)], "k string, v double")
    got = grouped_order_stats(rows, ["k"], {"p95": nearest_rank("v", 0.95)}, []).first()["p95"]
    assert got == 14.0 and not math.isnan(got)
