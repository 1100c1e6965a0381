"""Schema contract and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]


def _any_missing(names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(name).isNull() for name in names), F.lit(False))


def apply_contract(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, in its order, cast to its types.

    A missing column raises. A value that does not convert becomes NULL, so that
    ``split_required`` can set the row aside instead of failing the load. ``keep``
    names further columns to carry along.
    """
    absent = [field.name for field in schema if field.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from input: {absent}")
    return df.select(
        *(
            F.col(field.name).try_cast(field.dataType).alias(field.name)
            if df.schema[field.name].dataType != field.dataType
            else F.col(field.name)
            for field in schema
        ),
        *keep,
    )


def split_required(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column, rows set aside)."""
    missing = _any_missing(required_columns(schema))
    return df.filter(~missing), df.filter(missing)


def contract_faults(schema: T.StructType) -> Column:
    """What is wrong with a row, column by column: a required value is missing, or one does not convert."""

    def fault(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        fitted = value.try_cast(field.dataType)
        unread = F.when(value.isNotNull() & fitted.isNull(), F.lit(_unread(field)))
        if field.nullable:
            return unread
        return F.when(value.isNull(), F.lit(_absent(field))).otherwise(unread)

    return F.filter(F.array(*map(fault, schema)), lambda f: f.isNotNull())


def _absent(field: T.StructField) -> str:
    return f"{field.name} is missing"


def _unread(field: T.StructField) -> str:
    return f"{field.name} is no {field.dataType.simpleString()}"


def fault_names(schema: T.StructType) -> list[str]:
    """Every fault that ``contract_faults`` can find."""
    return [_absent(f) for f in schema if not f.nullable] + [_unread(f) for f in schema]


def split_contract(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy ``schema``, rejects) of ``df``.

    Rejects have the reasons, of every column at fault, and the row as JSON text. A
    row is at fault if a required value is missing or any value does not convert,
    in an optional column too. Every row is on exactly one side.
    """
    absent = [field.name for field in schema if field.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from input: {absent}")
    marked = df.withColumn("_faults", contract_faults(schema))
    good = apply_contract(marked.filter(F.size("_faults") == 0), schema)
    bad = marked.filter(F.size("_faults") > 0)
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return good, bad.select(F.array_join("_faults", "; ").alias("reason"), record.alias("record"))


def not_null_violations(df: DataFrame, names: list[str]) -> DataFrame:
    """Column name and number of NULLs for each of ``names``, in one pass."""
    counts = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in names))
    return counts.unpivot([], names, "column_name", "violations")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def unaccepted_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Values of ``column`` outside ``accepted``, with their number of rows; NULL is accepted."""
    return (
        df.filter(~F.col(column).isin(accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def reconcile_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key on both sides and their difference; both sides are reduced before the join."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    def found(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    both = counted(left, "left_rows").join(counted(right, "right_rows"), keys, "full_outer")
    return both.select(
        *keys,
        found("left_rows").alias("left_rows"),
        found("right_rows").alias("right_rows"),
        (found("left_rows") - found("right_rows")).alias("difference"),
    )
