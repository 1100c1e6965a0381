"""Statistics over query timings and the comparison of two storage formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.rounding import round_average, round_to, steady_avg
from gaugeline.operators.order_stats import grouped_order_stats, nearest_rank, percentile_cont


def run_stats(
    timings: DataFrame,
    keys: tuple[str, ...] = ("query", "format"),
    time: str = "time_ms",
    hot_rows: int | None = None,
) -> DataFrame:
    """Median, mean, min, max, 95th percentile by rank, and sample deviation per run group.

    With few runs the 95th percentile is the maximum. A single run deviates by 0.
    Rounding is half away from zero on the scaled double, as in SQL engines, not
    on the decimal text that Python's ``round`` goes by.
    """
    timed = timings.select(*keys, time).filter(F.col(time).isNotNull())
    deviation = round_to(F.coalesce(F.stddev_samp(time), F.lit(0.0)), 2)
    return grouped_order_stats(
        timed,
        list(keys),
        {"median": percentile_cont(time, 0.5), "p95": nearest_rank(time, 0.95)},
        [
            F.count(F.lit(1)).alias("runs"),
            round_average(steady_avg(F.col(time)), 2).alias("mean"),
            round_to(F.min(time), 2).alias("min"),
            round_to(F.max(time), 2).alias("max"),
            deviation.alias("stddev"),
        ],
        hot_rows,
    )


def overhead_pct(base: Column, other: Column) -> Column:
    """How much larger ``other`` is than ``base``, in percent to one decimal."""
    return round_to((other - base) / F.nullif(base, F.lit(0.0)) * 100.0, 1)


def verdict(overhead: Column, name: Column) -> Column:
    """The bands of the comparison and their texts."""
    return (
        F.when(overhead < -5, F.concat(name, F.lit(" FASTER")))
        .when(overhead < 5, "~Same")
        .when(overhead < 20, "Slight overhead")
        .when(overhead.isNotNull(), "Significant overhead")
    )


def overhead_report(
    stats: DataFrame, base: str, other: str, query: str = "query", fmt: str = "format"
) -> DataFrame:
    """Medians of two formats side by side, for queries timed in both."""
    medians = (
        stats.filter(F.col(fmt).isin(base, other))
        .groupBy(query)
        .pivot(fmt, [base, other])
        .agg(F.first("median"))
        .withColumnsRenamed({base: "base_median", other: "other_median"})
        .dropna(subset=["base_median", "other_median"])
    )
    overhead = overhead_pct(F.col("base_median"), F.col("other_median"))
    return medians.withColumn("overhead_pct", overhead).withColumn(
        "verdict", verdict(F.col("overhead_pct"), F.lit(other))
    )


def mean_overhead(report: DataFrame) -> DataFrame:
    """Average overhead over all compared queries, to one decimal."""
    return report.agg(
        F.count("overhead_pct").alias("queries"),
        round_average(steady_avg(F.col("overhead_pct")), 1).alias("avg_overhead"),
    )


def export_report(results: DataFrame, path: str) -> None:
    """Write results as JSON without the raw samples."""
    results.drop("raw_times").write.json(path)
