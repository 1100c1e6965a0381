"""Row changes as transformations; publishing the result is in ``sources.tables``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.skew import null_safe_join


def update_where(df: DataFrame, assignments: dict[str, Column], predicate: Column) -> DataFrame:
    """SQL UPDATE: every right-hand side sees the old row; a NULL predicate changes nothing."""
    return df.select(
        *(
            F.when(predicate, assignments[field.name])
            .otherwise(F.col(field.name))
            .cast(field.dataType)
            .alias(field.name)
            if field.name in assignments
            else F.col(field.name)
            for field in df.schema
        )
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """SQL DELETE: a NULL predicate keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def not_yet_landed(incoming: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has not been landed before; a NULL in a key equals another one."""
    return null_safe_join(incoming, landed.select(*keys).distinct(), keys, "left_anti")
