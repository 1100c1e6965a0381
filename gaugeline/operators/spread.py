"""Means and standard deviations from pieces that merge.

A piece has the number, mean and sum of squared deviations of some values of a
group. Pieces of any parts of a group give the pieces of the group:

    n = sum n_i,  mean = sum n_i mean_i / n,  squares = sum squares_i + sum n_i (mean_i - mean)^2

which loses nothing where the mean is large and the deviation small, as a sum of
plain squares would. The group's mean has to be known before the deviations of
the pieces' means from it, so merging aggregates the pieces twice; both times
they combine on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.rounding import coarse_part, fine_part, steady_avg
from gaugeline.operators.skew import null_safe_join
from gaugeline.operators.stage import settle

PIECE = ("n", "mean", "squares")


def spread_pieces(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One piece per group of ``keys``; ``mean`` and ``squares`` are NULL without a value."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.count(number).alias("n"),
        steady_avg(number).alias("mean"),
        (F.var_pop(number) * F.count(number)).alias("squares"),
    )


def merge_spread(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """The pieces of the groups of ``keys``, a part of the keys that ``pieces`` were made by.

    ``pieces`` are read twice: stage or store them first.
    """
    total = F.col("mean") * F.col("n")
    means = pieces.groupBy(*keys).agg(
        F.sum("n").alias("_n"),
        ((F.sum(coarse_part(total)) + F.sum(fine_part(total))) / F.nullif(F.sum("n"), F.lit(0))).alias("_mean"),
    )
    apart = F.col("mean") - F.col("_mean")
    # A group whose pieces all have the same mean gets it without what rounding adds.
    return (
        null_safe_join(pieces, settle(means, "group-means"), keys, "inner")
        .groupBy(*keys)
        .agg(
            F.first("_n").alias("n"),
            F.when(F.min("mean") == F.max("mean"), F.min("mean")).otherwise(F.first("_mean")).alias("mean"),
            F.sum(F.col("squares") + F.col("n") * apart * apart).alias("squares"),
        )
    )


def finished_spread(pieces: DataFrame) -> DataFrame:
    """Pieces as ``avg_temp`` and sample deviation ``stddev_temp``, NULL for a single value."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return pieces.select(
        *(c for c in pieces.columns if c not in PIECE),
        F.col("mean").alias("avg_temp"),
        deviation.alias("stddev_temp"),
    )
