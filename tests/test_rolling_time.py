"""Averages over a span of time against a plain computation."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.rolling import rolling_time_average

START = dt.datetime(2024, 3, 30, 12)


def expected(rows, seconds):
    out = []
    for key, time, value in rows:
        if time is None:
            out.append(None)
            continue
        held = [
            v for k, t, v in rows
            if k == key and t is not None and v is not None and time - dt.timedelta(seconds=seconds) <= t <= time
        ]
        if not held:
            out.append(None)
        elif any(map(math.isnan, held)) or {math.inf, -math.inf} <= set(held):
            out.append("nan")
        elif any(map(math.isinf, held)):
            out.append(next(v for v in held if math.isinf(v)))
        else:
            out.append(round(math.fsum(held) / len(held), 9))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    values = [None, math.nan, math.inf, -math.inf] if seed % 2 else [None]
    out = []
    for _ in range(300):
        time = START + dt.timedelta(seconds=rng.choice([3600 * rng.randrange(200), rng.randrange(700_000)]), microseconds=rng.choice([0, 1]))
        value = rng.choice(values) if rng.random() < 0.05 else rng.uniform(-40, 40)
        out.append((rng.choice(["A", "A", "B", None]), None if rng.random() < 0.02 else time, value))
    return out


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(("seed", "hot_rows"), [(1, 16_000_000), (2, 16_000_000), (3, 20), (4, 1)])
def test_against_plain_python(spark, kind, seed, hot_rows):
    rows = [(i, *row) for i, row in enumerate(rows_of(seed))]
    df = spark.createDataFrame(rows, f"id int, k string, t {kind}, v double")
    found = rolling_time_average(df, "k", "t", "v", "mean", hot_rows=hot_rows)
    assert found.columns == ["id", "k", "t", "v", "mean"]
    got = {r["id"]: r["mean"] for r in found.collect()}
    assert len(got) == len(rows)

    def plain(value):
        return value if value is None or math.isinf(value) else "nan" if math.isnan(value) else round(value, 9)

    assert [plain(got[i]) for i in range(len(rows))] == expected([r[1:] for r in rows], 86_400)


def test_both_ends_belong_to_the_frame(spark):
    day = dt.timedelta(days=1)
    times = [START, START + day, START + day + dt.timedelta(microseconds=1)]
    df = spark.createDataFrame([("A", t, float(i)) for i, t in enumerate(times)], "k string, t timestamp_ntz, v double")
    found = rolling_time_average(df, "k", "t", "v", "mean").orderBy("t").collect()
    assert [r["mean"] for r in found] == [0.0, 0.5, 1.5]


def test_cost_does_not_follow_the_frame(spark):
    """Frames grow from the start of the series: none is summed anew for every row."""
    df = spark.range(200_000).select(
        F.lit("A").alias("k"), F.timestamp_seconds(F.col("id")).alias("t"), (F.col("id") % 100).cast("double").alias("v")
    )
    found = rolling_time_average(df, "k", "t", "v", "mean")
    assert found.filter(F.col("t") >= F.timestamp_seconds(F.lit(100_000))).agg(F.max(F.abs(F.col("mean") - 49.5))).first()[0] < 0.01
    assert "specifiedwindowframe(RangeFrame, unboundedpreceding$(), currentrow$())" in found._jdf.queryExecution().toString()


def test_empty(spark):
    df = spark.createDataFrame([], "k string, t timestamp, v double")
    assert rolling_time_average(df, "k", "t", "v", "mean").collect() == []
