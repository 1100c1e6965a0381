"""Every delivered row is landed, repeated or late, over several runs and after failures."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.stage import stage_path
from gaugeline.plans import load
from gaugeline.sources import landed
from gaugeline.streaming import deliveries, ingest

SCHEMA = "id long, ts timestamp, v string"
START = dt.datetime(2024, 1, 10)
DAY = 86_400


def rows(spark, *found):
    return spark.createDataFrame(
        [(i, None if h is None else START + dt.timedelta(hours=h), v) for i, h, v in found], SCHEMA
    ).coalesce(1)


@pytest.fixture
def run(spark):
    path, target, checkpoint = (stage_path(spark, n) for n in ("landed", "target", "checkpoint"))

    def deliver(df, again=None):
        df.write.mode("append").parquet(path)
        stream = ingest.file_stream(spark, path, df.schema)
        deliveries.land_deliveries(stream, ["id"], "ts", DAY, target, again or checkpoint)
        return stream

    def found(stream):
        counts = {(r["batch"], r["outcome"]): r["row_count"] for r in deliveries.read_counts(spark, target).collect()}
        kept = sorted((r["id"] or 0, r["v"]) for r in deliveries.read_landed(spark, target, stream).collect())
        late = sorted((r["id"], r["v"]) for r in deliveries.read_late(spark, target, stream).collect())
        return counts, kept, late

    deliver.found = found
    return deliver


def test_outcomes_of_three_runs(spark, run):
    run(rows(spark, (1, 0, "a"), (2, 30, "b"), (3, 47, "c"), (None, 40, "n"), (4, None, "t")))
    # 1 again is too late to be told apart, 2 is a repeat, 5 is new within the day, 6 is late.
    run(rows(spark, (1, 0, "again"), (2, 30, "again"), (5, 24, "e"), (6, 22, "f"), (7, 60, "g"), (None, 41, "again")))
    stream = run(rows(spark, (7, 60, "again"), (8, 36, "h"), (9, 35, "i"), (4, None, "again"), (10, None, "k"), (8, 37, "again")))
    counts, kept, late = run.found(stream)
    assert counts == {
        (0, "landed"): 5,
        (1, "landed"): 2, (1, "late"): 2, (1, "repeated"): 2,
        (2, "landed"): 2, (2, "late"): 1, (2, "repeated"): 3,
    }
    assert sorted(v for _, v in kept) == ["a", "b", "c", "e", "g", "h", "k", "n", "t"]
    assert late == [(1, "again"), (6, "f"), (9, "i")]
    assert sum(counts.values()) == 17


def test_a_repeated_batch_counts_once(spark, run):
    """The same input under a new checkpoint replaces batch 0 instead of adding to it."""
    first = rows(spark, (1, 0, "a"), (1, 0, "b"), (2, 1, "c"))
    stream = run(first)
    before = run.found(stream)
    deliver_again = stage_path(spark, "checkpoint")
    stream = run(rows(spark), deliver_again)
    assert run.found(stream) == before
    assert before[0] == {(0, "landed"): 2, (0, "repeated"): 1}


def test_late_rows_have_a_reason(spark, run):
    run(rows(spark, (1, 100, "a")))
    stream = run(rows(spark, (2, 0, "b")))
    counts, kept, late = run.found(stream)
    assert late == [(2, "b")] and kept == [(1, "a")]


def test_faults_are_counted_while_writing(spark, tmp_path):
    def feature(**changes):
        given = {"timestamp": "2024-01-07T23:59:59+00:00", "stationId": "A", "temperature": {"value": 21}}
        return {"id": "o1", "type": "Feature", "properties": given | changes}

    documents = [
        json.dumps({"features": [feature(), feature(stationId=None, temperature={"value": "warm"}), feature(timestamp="soon")]}),
        json.dumps({"features": []}),
        json.dumps({}),
        '{"features": [{"id": "o1", ',
    ]
    for i, text in enumerate(documents):
        (tmp_path / f"{i}.json").write_text(text)
    path = stage_path(spark, "counted")
    counts = load.land_observations(landed.read_feature_collections(spark, str(tmp_path)), path)
    assert counts == {
        "loaded": 1,
        "rejected": 3,
        "unreadable document": 1,
        "station_id is missing": 1,
        "temperature_degC is no double": 1,
        "observation_timestamp is no timestamp": 1,
    }
    written = load.read_marked(spark, path)
    reasons = sorted(r["reason"] for r in written.filter("NOT accepted").collect())
    assert reasons == [
        "observation_timestamp is no timestamp",
        "station_id is missing; temperature_degC is no double",
        "unreadable document",
    ]
    good, rejects = load.load_observations(landed.read_feature_collections(spark, str(tmp_path)))
    columns = good.columns
    assert written.filter("accepted").select(*columns).collect() == good.collect()
    assert sorted(r["reason"] for r in rejects.collect()) == reasons
    kept = {r["record"] for r in written.filter("NOT accepted").collect()}
    assert kept == {r["record"] for r in rejects.collect()}


def test_documents_are_read_once(spark, tmp_path):
    """One job with one scan writes good rows and rejects and counts both."""
    (tmp_path / "0.json").write_text(json.dumps({"features": [{"id": "o"}]}))
    before = _jobs(spark)
    load.land_observations(landed.read_feature_collections(spark, str(tmp_path)), stage_path(spark, "counted"))
    assert _jobs(spark) - before == 1


def _jobs(spark) -> int:
    """Jobs that this application has run so far."""
    return spark.range(1).select(F.lit(0)).rdd.context.statusTracker().getJobIdsForGroup(None).__len__()
