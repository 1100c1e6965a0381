"""Finding groups that one task should not sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.stage import settle, stage

# Rows one task may sort for one group; it spills well before this hurts.
HOT_ROWS = 4_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same: Column = reduce(
        lambda a, b: a & b, (F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys)
    )
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_right_{k}" for k in keys))


def split_hot(
    df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, counts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """``df`` as (rows of ordinary groups, rows of groups above ``hot_rows`` or None).

    A table of at most ``hot_rows`` rows has no hot group, which a row count settles:
    from file footers for a staged table, by a pass over it for any other. Otherwise one pre-aggregated pass over the keys
    finds them; there are at most rows / ``hot_rows`` of them. The joins that
    separate them keep a third of the table in one key spread as it was read,
    because the list is small enough to broadcast.
    """
    if counts is None:
        if df.count() <= hot_rows:
            return df, None
        counts = group_counts(df, keys)
    hot = counts.filter(F.col("_rows") > hot_rows).select(*keys)
    if hot.isEmpty():
        return df, None
    hot = stage(hot, "hot-keys")
    return (
        null_safe_join(df, hot, keys, "left_anti"),
        null_safe_join(df, hot, keys, "left_semi"),
    )


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per group, settled so that later passes do not count again."""
    return settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "group-counts")
