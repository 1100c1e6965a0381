"""Distance of each row from the mean of its group, in standard deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.rounding import steady_avg
from gaugeline.operators.stage import settle

# Fixed values.
EXTREME_ABOVE = 2.0
UNUSUAL_ABOVE = 1.0
CATEGORIES = ["Normal", "Unusual", "Extreme"]


def group_spread(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and sample deviation per group; the deviation of a single row is NULL."""
    return df.groupBy(key).agg(
        steady_avg(F.col(value)).alias("avg_temp"),
        F.stddev_samp(value).alias("stddev_temp"),
    )


def with_zscore(
    df: DataFrame, key: str, value: str, spread: DataFrame | None = None
) -> DataFrame:
    """Add ``avg_temp``, ``stddev_temp`` and ``temp_z_score``.

    The score is NULL for a NULL value and for a group without spread. The group
    table is settled before the join, so rows are shuffled only if the groups
    outgrow a broadcast. Rows with a NULL key have no group and drop out.
    """
    spread = spread if spread is not None else group_spread(df, key, value)
    distance = F.abs(F.col(value) - F.col("avg_temp"))
    return df.join(settle(spread, "group-spread"), key).withColumn(
        "temp_z_score", distance / F.nullif(F.col("stddev_temp"), F.lit(0.0))
    )


def category(score: Column) -> Column:
    """Extreme above 2, Unusual above 1, otherwise Normal."""
    return (
        F.when(score > EXTREME_ABOVE, CATEGORIES[2])
        .when(score > UNUSUAL_ABOVE, CATEGORIES[1])
        .otherwise(CATEGORIES[0])
    )
