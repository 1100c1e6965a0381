"""Dense positions in a sorted table without a single-partition window."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.functions.timeparts import epoch_seconds
from gaugeline.operators.skew import HOT_ROWS, group_counts, null_safe_join, split_hot
from gaugeline.operators.stage import stage

# Rows per task of a range sort, and the most tasks: beyond, they sort more and spill.
SORT_ROWS = 2_000_000
SORT_TASKS = 20_000

# Rows per time slot that numbering aims at, and the fewest and most slots.
SLOT_ROWS = 1_000_000
SLOTS = (64, 10_000)

# monotonically_increasing_id keeps the partition above and the row below this bit.
_ROW_BITS = 33


def ascending(names: list[str]) -> list[Column]:
    """Ascending order with NULLs last."""
    return [F.col(name).asc_nulls_last() for name in names]


def _sorted_stage(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, staged with ``_part`` and ``_row``.

    The incoming row id is the last sort key, so even rows that agree on every
    other key spread over partitions, whose number follows the number of rows.
    The input is staged with its row ids: a retried task must not number its rows
    anew, and counting, sampling and sorting would otherwise each compute it. The
    result is staged because Spark samples the partition bounds, so that every
    later pass sees the same layout.
    """
    tied = stage(df.withColumn("_tie", F.monotonically_increasing_id()), "unsorted")
    sort_keys = ascending([*order, "_tie"])
    ordered = (
        tied.repartitionByRange(min(tied.count() // SORT_ROWS + 1, SORT_TASKS), *sort_keys)
        .sortWithinPartitions(*sort_keys)
        .drop("_tie")
        .withColumn("_id", F.monotonically_increasing_id())
    )
    staged = stage(ordered, "sorted")
    return staged.withColumns(
        {
            "_part": F.shiftright("_id", _ROW_BITS),
            "_row": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_id")


def _with_offsets(staged: DataFrame, weight: Column) -> DataFrame:
    """Add ``_before``: the weight held by all earlier sort partitions.

    The offsets have one row per sort partition, at most ``SORT_TASKS``, which bounds
    both the ordered window over them and the broadcast.
    """
    sizes = staged.groupBy("_part").agg(F.sum(weight).alias("_size"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("bigint")).alias("_before")
    )
    return staged.join(F.broadcast(offsets), "_part")


def global_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Number all rows 1..n in ``order``, whatever the distribution of the keys."""
    placed = _with_offsets(_sorted_stage(df, order), F.lit(1).cast("bigint"))
    return placed.withColumn(name, F.col("_before") + F.col("_row") + 1).drop(
        "_part", "_row", "_before"
    )


def running_total(df: DataFrame, order: list[str], weight: str, name: str) -> DataFrame:
    """Running sum of the bigint ``weight`` over all rows in ``order``.

    Within a sort partition the sum is a window over that partition's rows.
    """
    placed = _with_offsets(_sorted_stage(df, order), F.col(weight))
    within = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
    return placed.withColumn(name, F.col("_before") + F.sum(weight).over(within)).drop(
        "_part", "_row", "_before"
    )


def rank_hot(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Row number within each group, for groups of any size.

    All rows are numbered in (keys, order); a group's first number is its offset.
    """
    placed = global_position(df, [*keys, *order], "_position")
    starts = placed.groupBy(*keys).agg(F.min("_position").alias("_start"))
    return (
        null_safe_join(placed, stage(starts, "group-starts"), keys, "inner")
        .withColumn(name, F.col("_position") - F.col("_start") + 1)
        .drop("_position", "_start")
    )


def _with_slots(df: DataFrame, ts: str) -> DataFrame:
    """Add ``_slot``, the number of the time slot a row falls into; NULL times come last.

    Slots hold about equally many rows, whatever the times are: their edges are
    quantiles from a sketch, at most ``SLOTS[1]`` numbers. Rows of one second
    share a slot.
    """
    seconds = df.withColumn("_seconds", epoch_seconds(df, ts).cast("double"))
    rows = seconds.count()
    slots = min(max(rows // SLOT_ROWS, SLOTS[0]), SLOTS[1])
    shares = [i / slots for i in range(1, slots)]
    edges = seconds.agg(F.percentile_approx("_seconds", shares, 10 * slots)).first()[0]
    splits = [-math.inf, *sorted(set(edges or [0.0])), math.inf]
    placed = Bucketizer(splits=splits, inputCol="_seconds", outputCol="_slot", handleInvalid="keep")
    return placed.transform(seconds).drop("_seconds")


def number_rows(
    df: DataFrame,
    ts: str,
    tie: list[str],
    name: str = "row_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Dense 1..n numbers in (``ts``, ``tie``) order, NULL times last.

    Rows are numbered within their time slot and shifted by the number of rows in
    earlier slots. Only the counts per slot, at most ``SLOTS[1]``, meet in one
    partition. Slots that come out above ``hot_rows`` rows, such as one crowded
    instant, are numbered by a range sort.
    """
    order = [ts, *tie]
    slotted = _with_slots(df, ts)
    counts = group_counts(slotted, ["_slot"])
    earlier = W.orderBy(F.col("_slot").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_slot", F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("bigint")).alias("_before")
    )
    cold, hot = split_hot(slotted, ["_slot"], hot_rows, counts)
    within = W.partitionBy("_slot").orderBy(*ascending(order))
    ranked = cold.withColumn("_rank", F.row_number().over(within).cast("bigint"))
    if hot is not None:
        ranked = ranked.unionByName(rank_hot(hot, ["_slot"], order, "_rank"))
    return (
        null_safe_join(ranked, offsets, ["_slot"], "inner")
        .withColumn(name, F.col("_before") + F.col("_rank"))
        .drop("_slot", "_before", "_rank")
    )
