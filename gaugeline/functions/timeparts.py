"""Time parts typed as SQL engines type them: bigint parts, midnight timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_start(df: DataFrame, name: str) -> Column:
    """Midnight of the row's day, in the type of the timestamp column.

    Going through DATE keeps a zone-less timestamp clear of the session zone.
    """
    return F.to_date(F.col(name)).cast(df.schema[name].dataType)


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def month_of(ts: Column) -> Column:
    return F.month(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970 as a bigint, never decreasing as the column grows.

    A zone-less timestamp is taken apart: converting it would run backwards where
    the session zone skips an hour.
    """
    ts = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        day = F.unix_date(F.to_date(ts)).cast("bigint")
        return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_seconds(ts)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 as a bigint; a zone-less timestamp is taken as it reads."""
    ts = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        fraction = (F.date_part(F.lit("SECONDS"), ts) * 1_000_000).cast("bigint")
        day = F.unix_date(F.to_date(ts)).cast("bigint")
        return ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000_000 + fraction
    return F.unix_micros(ts)


def moment(df: DataFrame, name: str, text: str) -> Column:
    """``text`` as a literal of the column's own type, so comparisons reach the scan."""
    return F.lit(text).cast(df.schema[name].dataType)
