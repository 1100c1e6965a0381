"""Redelivered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_deliveries(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """One row per key; keys are remembered for ``delay`` of event time, older rows are dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
