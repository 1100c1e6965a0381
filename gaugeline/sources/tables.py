"""Parquet tables in the session catalog: create, read, append, replace, update, delete.

Plain Parquet has no row-level changes, so a change writes new files first and then
points the table at them. A replace of the whole table is one catalog change:
readers see the old rows or the new ones, and a running read keeps its files.

Partitions are found in the folders of the table's location, not listed in the
catalog, so pointing at a new location moves all of them at once and no list of
partitions passes through the driver. The price is that a session's first read
lists the folders. A change of some partitions writes into the location, one
partition after the other; readers that must not see it in between need
``replace_rows``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators.mutate import delete_where, update_where
from gaugeline.operators.quality import required_columns
from gaugeline.operators.skew import null_safe_join
from gaugeline.operators.stage import delete_path, stage
from gaugeline.sources.landed import read_footers

_REQUIRED = "gaugeline.required"
_LISTED = "spark.sql.hive.manageFilesourcePartitions"

# Types that hold every value of the type before them.
_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_WIDER_FLOAT = [T.ByteType(), T.ShortType(), T.FloatType(), T.IntegerType(), T.DoubleType()]


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    folder: str,
    partition_by: tuple[str, ...] = (),
    using: str = "parquet",
) -> None:
    """Create ``name`` if absent; its files live in versioned folders below ``folder``.

    Spark drops NOT NULL from Parquet tables, so the required columns are kept as
    a table property that every write checks. ``using`` may name a table format on
    the classpath that changes rows itself; its tables are then changed by SQL.
    """
    _create(spark, name, schema, _version_path(folder), partition_by, using)


def _create(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partition_by: tuple[str, ...], using: str
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    kept = spark.conf.get(_LISTED, None)
    spark.conf.set(_LISTED, "false")
    try:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}{parts} LOCATION '{path}' "
            f"TBLPROPERTIES ('{_REQUIRED}' = '{','.join(required_columns(schema))}')"
        )
    finally:
        spark.conf.unset(_LISTED) if kept is None else spark.conf.set(_LISTED, kept)


def recreate_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    folder: str,
    partition_by: tuple[str, ...] = (),
) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, schema, folder, partition_by)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_footers(spark: SparkSession, name: str) -> DataFrame:
    """The table as a scan whose counts and bounds come from file footers."""
    location = _location(spark, name)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    # A table that was never written to has no folder yet.
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return read_footers(spark, location, schema=spark.table(name).schema)


def append_rows(df: DataFrame, name: str) -> None:
    """Append, matching columns by name; a NULL in a required column fails the write."""
    _fitted(df, name).write.insertInto(name)


def replace_rows(df: DataFrame, name: str) -> None:
    """Replace all rows; ``df`` may be derived from the table itself."""
    spark = df.sparkSession
    path = _version_path(_location(spark, name).rsplit("/", 1)[0])
    _write_version(_fitted(df, name), path, _partition_columns(spark, name))
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _write_version(df: DataFrame, path: str, parts: list[str]) -> None:
    (df.write.partitionBy(*parts) if parts else df.write).parquet(path)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions that occur in ``df``; the others keep their files.

    ``df`` must not read from the table: stage it first.
    """
    spark = df.sparkSession
    writer = _fitted(df, name).write.mode("overwrite").partitionBy(*_partition_columns(spark, name))
    writer.option("partitionOverwriteMode", "dynamic").parquet(_location(spark, name))
    spark.catalog.refreshTable(name)


def save_mart(df: DataFrame, name: str, folder: str, partition_by: tuple[str, ...] = ()) -> None:
    """Create or replace ``name`` with the rows and the columns of ``df``.

    The files are complete before the catalog changes. With the columns as they
    were, the table moves in one change; with other columns it is dropped and
    created again over the new files, between which its name is unknown.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        same = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema]
        order = [*(c for c in df.columns if c not in partition_by), *partition_by]
        if same == [(c, df.schema[c].dataType.simpleString()) for c in order] and tuple(
            _partition_columns(spark, name)
        ) == tuple(partition_by):
            replace_rows(df, name)
            return
    path = _version_path(folder)
    _write_version(_dealt(df, list(partition_by)), path, list(partition_by))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _create(spark, name, df.schema, path, partition_by, "parquet")
    spark.catalog.refreshTable(name)


def save_view(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a view, which computes its rows whenever it is read."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop a namespace with its tables and views; files at given locations stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def update_rows(
    spark: SparkSession, name: str, assignments: dict[str, Column], predicate: Column
) -> None:
    """UPDATE; on a partitioned table only partitions with matching rows are rewritten."""
    moved = set(assignments) & set(_partition_columns(spark, name))
    if moved:
        raise ValueError(f"partition columns cannot be updated: {sorted(moved)}")
    _rewrite(spark, name, predicate, lambda df: update_where(df, assignments, predicate))


def delete_rows(spark: SparkSession, name: str, predicate: Column) -> None:
    """DELETE; on a partitioned table only partitions with matching rows are rewritten."""
    _rewrite(spark, name, predicate, lambda df: delete_where(df, predicate))


def drop_old_versions(spark: SparkSession, name: str) -> None:
    """Delete the folders of replaced versions; call it when no reader uses them."""
    jvm = spark.sparkContext._jvm
    current = jvm.org.apache.hadoop.fs.Path(_location(spark, name))
    fs = current.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(current.getParent()):
        if status.getPath().getName() != current.getName():
            fs.delete(status.getPath(), True)


def _version_path(folder: str) -> str:
    return f"{folder.rstrip('/')}/v-{uuid.uuid4().hex}"


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {name}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _holds(held: T.DataType, given: T.DataType) -> bool:
    """Whether every value of ``given`` fits a column of type ``held`` unchanged."""
    if held.simpleString() == given.simpleString() or isinstance(given, T.NullType):
        return True
    ranks = [w for w in (_WIDER, _WIDER_FLOAT) if held in w and given in w]
    if any(w.index(given) < w.index(held) for w in ranks):
        return True
    return isinstance(given, T.DateType) and isinstance(held, (T.TimestampType, T.TimestampNTZType))


def _fitted(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the columns and types of the table, ready to be written.

    Columns that only one side has and types that could lose values raise before
    anything is written.
    """
    spark = df.sparkSession
    properties = dict(map(tuple, spark.sql(f"SHOW TBLPROPERTIES {name}").collect()))
    required = properties.get(_REQUIRED, "").split(",")
    schema = spark.table(name).schema
    odd = sorted(set(df.columns) ^ set(schema.names))
    if odd:
        raise ValueError(f"{name} and the rows differ in columns: {odd}")
    unsafe = [f.name for f in schema if not _holds(f.dataType, df.schema[f.name].dataType)]
    if unsafe:
        raise ValueError(f"{name} cannot hold the types of: {unsafe}")

    def checked(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if df.schema[field.name].dataType.simpleString() != field.dataType.simpleString():
            value = value.cast(field.dataType)
        if field.name in required:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required column {field.name}")))
        return value.alias(field.name)

    return _dealt(df.select(*map(checked, schema)), _partition_columns(spark, name))


def _dealt(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows by partition value: otherwise every task opens a file in every partition.

    Unlike a plain repartition, a rebalance splits partitions that come out too large.
    """
    return df.hint("rebalance", *parts) if parts else df


def _rewrite(
    spark: SparkSession, name: str, predicate: Column, change: Callable[[DataFrame], DataFrame]
) -> None:
    table = spark.table(name)
    parts = _partition_columns(spark, name)
    if not parts:
        replace_rows(change(table), name)
        return
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    matching = table.filter(predicate).select(*parts, folder.alias("_folder")).distinct()
    touched = stage(matching, "touched-partitions")
    changed = stage(change(null_safe_join(table, touched, parts, "left_semi")), "changed-rows")
    replace_partitions(changed, name)
    # A dynamic overwrite leaves a partition alone that has no rows left.
    emptied = null_safe_join(touched, changed.select(*parts).distinct(), parts, "left_anti")
    for row in emptied.select("_folder").toLocalIterator():
        delete_path(spark, row["_folder"])
    spark.catalog.refreshTable(name)
