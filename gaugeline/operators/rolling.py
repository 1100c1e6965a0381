"""Rolling averages over the last rows, or the last hours, of each series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.functions.rounding import coarse_part, fine_part, steady_avg_over
from gaugeline.functions.timeparts import epoch_micros
from gaugeline.operators.ordering import ascending, rank_hot
from gaugeline.operators.skew import split_hot

# Rows of one series that a task may sort; they are narrow, and the sort spills.
SERIES_ROWS = 16_000_000


def rolling_average(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    name: str,
    rows: int = 24,
    hot_rows: int = SERIES_ROWS,
) -> DataFrame:
    """Average of ``value`` over the current and the ``rows - 1`` earlier rows of its series.

    Series above ``hot_rows`` rows are cut into blocks of consecutive rows. The
    last ``rows - 1`` rows of a block are also sent to the next one as lead-in, so
    each block computes its averages alone and no row is more than doubled.
    """
    cold, hot = split_hot(df, [key], hot_rows)
    window = W.partitionBy(key).orderBy(*ascending(order)).rowsBetween(1 - rows, 0)
    result = cold.withColumn(name, steady_avg_over(F.col(value), window))
    if hot is None:
        return result
    return result.unionByName(_blockwise(hot, key, order, value, name, rows, hot_rows))


def _blockwise(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    name: str,
    rows: int,
    hot_rows: int,
) -> DataFrame:
    size = max(hot_rows, rows)
    ranked = rank_hot(df, [key], order, "_rank").withColumns(
        {
            "_home": F.floor((F.col("_rank") - 1) / size),
            "_from_end": F.lit(size) - (F.col("_rank") - 1) % size,
        }
    )
    lead_in = F.when(F.col("_from_end") < rows, F.array("_home", F.col("_home") + 1))
    spread = ranked.withColumn("_block", F.explode(F.coalesce(lead_in, F.array("_home"))))
    window = W.partitionBy(key, "_block").orderBy("_rank").rowsBetween(1 - rows, 0)
    return (
        spread.withColumn(name, steady_avg_over(F.col(value), window))
        .filter(F.col("_block") == F.col("_home"))
        .drop("_rank", "_home", "_from_end", "_block")
    )


def rolling_time_average(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    name: str,
    seconds: int = 86_400,
    hot_rows: int = SERIES_ROWS,
) -> DataFrame:
    """Average of ``value`` over the rows of the series from ``seconds`` before a row up to its instant.

    Both ends belong to the frame, so all rows of an instant have the same average.
    A row without time has none. Sums run from the start of the series, and the
    sum up to the frame's start is taken off again: a row costs the same however
    many rows its frame has.

    Series above ``hot_rows`` rows are cut into blocks of time of at least
    ``seconds``, and of so many rows; what a block's first frames reach back to is
    also sent to it. Instants of one series within twice ``seconds`` share a task.
    """
    frame = seconds * 1_000_000
    timed = df.withColumn("_micros", epoch_micros(df, time))
    cold, hot = split_hot(timed, [key], hot_rows)
    average = F.when(F.col("_micros").isNotNull(), _time_average(F.col(value), [key], frame))
    result = cold.withColumn(name, average)
    if hot is not None:
        result = result.unionByName(_time_blocks(hot, key, value, name, frame, hot_rows))
    return result.drop("_micros")


def _time_average(value: Column, keys: list[str], frame: int) -> Column:
    """The average in each row's frame: running sums at its end less those before its start.

    Sums of coarse parts are exact, so nothing is lost by the difference; infinity
    and NaN would never leave a running sum and are counted instead.
    """
    ordered = W.partitionBy(*keys).orderBy("_micros")
    upto = ordered.rangeBetween(W.unboundedPreceding, 0)
    earlier = ordered.rangeBetween(W.unboundedPreceding, -frame - 1)
    number = value.cast("double")
    infinite = F.abs(number) == float("inf")
    usable = F.when(~F.isnan(number) & ~infinite, number)

    def within(part: Column) -> Column:
        return F.sum(part).over(upto) - F.coalesce(F.sum(part).over(earlier), F.lit(0))

    def times(condition: Column) -> Column:
        return within(F.when(condition, 1).otherwise(0))

    total = within(coarse_part(usable)) + within(fine_part(usable))
    known = times(number.isNotNull())
    up, down = times(number == float("inf")), times(number == float("-inf"))
    return (
        F.when(known == 0, None)
        .when((times(F.isnan(number)) > 0) | ((up > 0) & (down > 0)), float("nan"))
        .when(up > 0, float("inf"))
        .when(down > 0, float("-inf"))
        .otherwise(F.coalesce(total, F.lit(0.0)) / known)
    )


def _time_blocks(df: DataFrame, key: str, value: str, name: str, frame: int, hot_rows: int) -> DataFrame:
    crowd = df.groupBy(key, F.floor(F.col("_micros") / frame)).agg(F.count(F.lit(1)).alias("_rows"))
    most = crowd.agg(F.max("_rows")).first()[0] or 1
    size = frame * max(1, hot_rows // most)
    home = F.floor(F.col("_micros") / size)
    ahead = F.when(F.floor((F.col("_micros") + frame) / size) > F.col("_home"), F.array("_home", F.col("_home") + 1))
    placed = df.withColumn("_home", home)
    spread = placed.withColumn("_block", F.explode(F.coalesce(ahead, F.array("_home"))))
    average = F.when(F.col("_micros").isNotNull(), _time_average(F.col(value), [key, "_block"], frame))
    return (
        spread.withColumn(name, average)
        .filter(F.col("_block").eqNullSafe(F.col("_home")))
        .drop("_home", "_block")
    )
