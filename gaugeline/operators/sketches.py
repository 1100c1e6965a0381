"""Distinct counts and percentiles from sketches that are stored and merged.

A sketch of a day's rows is a few kilobytes whatever their number. Sketches of
any parts of a group give that of the group, so a month is made of its days and
rows are read once. The exact operators are ``count_distinct`` and
``order_stats``; these here are for tables where reading all rows again for every
period is too dear, and their error is stated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^14 registers: a relative standard error of 0.8 % for large counts.
LG_REGISTERS = 14
# Values a quantile sketch keeps per level: a rank error of 0.45 %, see ``rank_error``.
KEPT_VALUES = 1_000


def distinct_error(lg_registers: int = LG_REGISTERS) -> float:
    """Three relative standard errors of a distinct count."""
    return 3 * 1.04 / 2 ** (lg_registers / 2)


def rank_error(kept: int = KEPT_VALUES) -> float:
    """How far, as a share of all rows, a percentile's rank may be off, with 99 % confidence."""
    return 2.296 / kept**0.9021


def distinct_sketches(df: DataFrame, keys: list[str], column: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Per group: rows and a sketch of the distinct values of ``column``, NULL without any."""
    value = F.col(column)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.when(F.count(value) > 0, F.hll_sketch_agg(value, F.lit(lg_registers))).alias("sketch"),
    )


def united_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``distinct_sketches`` of coarser groups, from those of finer ones."""
    return sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.when(F.count("sketch") > 0, F.hll_union_agg("sketch")).alias("sketch"),
    )


def distinct_estimate(sketch: Column) -> Column:
    """The number of distinct values, 0 without any."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("long"))


def quantile_sketches(df: DataFrame, keys: list[str], columns: list[str], kept: int = KEPT_VALUES) -> DataFrame:
    """Per group: rows and for each column a sketch of its values, NULL without any.

    NULL and NaN are left out, as neither has a rank.
    """

    def sketch(column: str) -> Column:
        value = F.nanvl(F.col(column).cast("double"), F.lit(None))
        return F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, kept)).alias(f"sketch_{column}")

    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *map(sketch, columns))


def merged_quantiles(sketches: DataFrame, keys: list[str], kept: int = KEPT_VALUES) -> DataFrame:
    """``quantile_sketches`` of coarser groups, from those of finer ones."""
    names = [c for c in sketches.columns if c.startswith("sketch_")]
    return sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        *(F.when(F.count(c) > 0, F.kll_merge_agg_double(c, kept)).alias(c) for c in names),
    )


def sketched_percentile(column: str, p: float) -> Column:
    """A value whose rank among the values of ``column`` is within ``rank_error`` of ``p``."""
    return F.kll_sketch_get_quantile_double(F.col(f"sketch_{column}"), F.lit(p))
