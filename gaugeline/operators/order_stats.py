"""Exact percentiles and other order statistics per group.

One shuffle by group serves the statistics and all other aggregates: where the
rows of a group meet they are ranked once per measure, by a window that sorts and
spills like any other, and one aggregation picks the values at the asked places.
A group of more than ``WINDOW_VALUES`` rows goes another way: its values are
counted, so equal readings are one row, and placed by a range sort over all
tasks. Both ways read the same places of the same order, so the switch changes
the plan and never the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.operators.ordering import running_total
from gaugeline.operators.skew import null_safe_join, split_hot
from gaugeline.operators.stage import stage

# Rows of one group that a window sorts in one task.
WINDOW_VALUES = 4_000_000


@dataclass(frozen=True)
class OrderStat:
    """A value read at ``place(n)``, a 0-based fractional position among n sorted values."""

    column: str
    place: Callable[[Column], Column]


def percentile_cont(column: str, p: float) -> OrderStat:
    """Interpolated percentile."""
    return OrderStat(column, lambda n: (n - 1) * p)


def nearest_rank(column: str, p: float) -> OrderStat:
    """The element at index int(n * p), at most the last one."""
    return OrderStat(column, lambda n: F.least(F.floor(n * p), n - 1).cast("double"))


def grouped_order_stats(
    df: DataFrame,
    keys: list[str],
    stats: dict[str, OrderStat],
    aggregates: list[Column],
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per group: ``keys``, ``aggregates`` and the named order statistics.

    NULLs are ignored; a group without values yields NULL. NaN is the largest value.
    Groups above ``hot_rows`` rows, by default ``WINDOW_VALUES``, are placed by a range sort.
    """
    cold, hot = split_hot(df, keys, WINDOW_VALUES if hot_rows is None else hot_rows)
    result = _by_window(cold, keys, stats, aggregates)
    if hot is None:
        return result
    return result.unionByName(_by_range_sort(hot, keys, stats, aggregates))


def _columns(stats: dict[str, OrderStat]) -> dict[str, str]:
    """A short name for each measure, as it is part of every sort key."""
    return {column: f"_{i}" for i, column in enumerate(dict.fromkeys(stat.column for stat in stats.values()))}


def _by_window(
    df: DataFrame, keys: list[str], stats: dict[str, OrderStat], aggregates: list[Column]
) -> DataFrame:
    names = _columns(stats)
    ranked = df.repartition(*keys)
    for column, name in names.items():
        ordered = W.partitionBy(*keys).orderBy(F.col(column).cast("double").asc_nulls_last())
        whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        ranked = ranked.withColumns(
            {f"_at{name}": F.row_number().over(ordered) - 1, f"_n{name}": F.count(column).over(whole)}
        )

    def pick(stat: OrderStat, position: Column) -> Column:
        return F.max(F.when(F.col(f"_at{names[stat.column]}") == position, F.col(stat.column).cast("double")))

    def size(stat: OrderStat) -> Column:
        return F.col(f"_n{names[stat.column]}")

    grouped = ranked.groupBy(*keys).agg(*aggregates, *_picks(stats, pick, size))
    return _interpolated(grouped, stats)


def _by_range_sort(
    df: DataFrame, keys: list[str], stats: dict[str, OrderStat], aggregates: list[Column]
) -> DataFrame:
    names = _columns(stats)
    measured = df.select(*keys, *(F.col(c).cast("double").alias(name) for c, name in names.items()))
    counted = stage(_counted(measured, keys, names), "counted-values")
    placed = _placed(counted, [*keys, "_measure"])

    def pick(stat: OrderStat, position: Column) -> Column:
        held = (F.col("_end") - F.col("_rows") <= position) & (position < F.col("_end"))
        return F.max(F.when((F.col("_measure") == names[stat.column]) & held, F.col("_value")))

    def size(stat: OrderStat) -> Column:
        return F.when(F.col("_measure") == names[stat.column], F.col("_n"))

    found = placed.groupBy(*keys).agg(*_picks(stats, pick, size))
    totals = df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct()
    return _interpolated(null_safe_join(totals, found, keys, "left"), stats)


def _counted(measured: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """Each value of a group and measure once, with its number of rows."""
    return (
        measured.unpivot(keys, list(names.values()), "_measure", "_value")
        .filter(F.col("_value").isNotNull())
        .groupBy(*keys, "_measure", "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )


def _placed(counted: DataFrame, group: list[str]) -> DataFrame:
    """Add ``_end``, the rows up to and including each value, and ``_n``, the rows of the group."""
    totals = stage(running_total(counted, [*group, "_value"], "_rows", "_upto"), "running-totals")
    spans = totals.groupBy(*group).agg(
        F.min(F.col("_upto") - F.col("_rows")).alias("_start"), F.sum("_rows").alias("_n")
    )
    return (
        null_safe_join(totals, stage(spans, "group-spans"), group, "inner")
        .withColumn("_end", F.col("_upto") - F.col("_start"))
        .drop("_upto", "_start")
    )


def _picks(
    stats: dict[str, OrderStat],
    pick: Callable[[OrderStat, Column], Column],
    size: Callable[[OrderStat], Column],
) -> list[Column]:
    """Per statistic: its place and the values on both sides of it."""
    picks = []
    for name, stat in stats.items():
        place = stat.place(size(stat))
        picks += [
            pick(stat, F.floor(place)).alias(f"_low_{name}"),
            pick(stat, F.ceil(place)).alias(f"_high_{name}"),
            F.max(place).alias(f"_place_{name}"),
        ]
    return picks


def _interpolated(df: DataFrame, stats: dict[str, OrderStat]) -> DataFrame:
    for name in stats:
        low, high, place = (F.col(f"_{part}_{name}") for part in ("low", "high", "place"))
        share = place - F.floor(place)
        # A place on an element takes it as it is: infinity times zero would be NaN.
        between = F.when(share > 0, low * (F.lit(1.0) - share) + high * share).otherwise(low)
        df = df.withColumn(name, between)
        df = df.drop(f"_low_{name}", f"_high_{name}", f"_place_{name}")
    return df
