"""The contract and the quality reports."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from gaugeline.operators import quality
from gaugeline.plans.analytics import warm_samples
from gaugeline.schemas import SAMPLES


def test_contract(spark):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType(), False), T.StructField("x", T.DoubleType())]
    )
    rows = spark.createDataFrame([("1.5", "1", 0), ("bad", "2", 0), ("3", "n/a", 0)], "x string, id string, more int")
    fitted = quality.apply_contract(rows, schema)
    assert fitted.dtypes == [("id", "int"), ("x", "double")]
    good, aside = quality.split_required(fitted, schema)
    assert {tuple(r) for r in good.collect()} == {(1, 1.5), (2, None)}
    assert {tuple(r) for r in aside.collect()} == {(None, 3.0)}
    with pytest.raises(ValueError, match="missing"):
        quality.apply_contract(rows.drop("x"), schema)


def test_rejects_have_reasons_and_miss_nothing(spark):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType(), False), T.StructField("x", T.DoubleType())]
    )
    rows = spark.createDataFrame(
        [("1", "1.5"), ("2", None), ("bad", "2"), ("3", "n/a"), (None, "oops")], "id string, x string"
    )
    good, rejects = quality.split_contract(rows, schema)
    assert {tuple(r) for r in good.collect()} == {(1, 1.5), (2, None)}
    assert {tuple(r) for r in rejects.collect()} == {
        ("id is no int", '{"id":"bad","x":"2"}'),
        ("x is no double", '{"id":"3","x":"n/a"}'),
        ("id is missing; x is no double", '{"x":"oops"}'),
    }
    with pytest.raises(ValueError, match="missing"):
        quality.split_contract(rows.drop("x"), schema)


def test_reports(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "z")], "k int, v string")
    missing = {tuple(r) for r in quality.not_null_violations(rows, ["k", "v"]).collect()}
    assert missing == {("k", 1), ("v", 1)}
    assert [tuple(r) for r in quality.duplicate_keys(rows, ["k", "v"]).collect()] == [(1, "a", 2)]
    assert [tuple(r) for r in quality.unaccepted_values(rows, "v", ["a"]).collect()] == [("z", 1)]


def test_reconcile(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a",), ("c",)], "k string")
    got = {tuple(r) for r in quality.reconcile_counts(left, right, ["k"]).collect()}
    assert got == {("a", 2, 1, 1), ("b", 1, 0, 1), ("c", 0, 1, -1)}


def test_samples(spark):
    rows = [
        (i, dt.datetime(2024, 5, 6, i), f"place {i}", temperature, ["a", "b"])
        for i, temperature in enumerate([3.5, 20.0, 30.25, None, 20.5])
    ]
    samples = spark.createDataFrame(rows, SAMPLES)
    got = warm_samples(samples, ["name"], "timestamp", "temperature").collect()
    assert [tuple(r) for r in got] == [("place 2", 30.25, 2), ("place 4", 20.5, 4)]
