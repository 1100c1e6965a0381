"""Compare a registered query with its SQL: types, row count and exact values."""

from __future__ import annotations

import math
import re

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_SAME = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    expected_types = {n: _SAME.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    actual_types = dict(df.dtypes)
    problems = []
    if expected_types != actual_types:
        problems.append(f"types: expected {expected_types}, got {actual_types}")
        if set(expected_types) != set(actual_types):
            return problems
    names = sorted(actual_types)
    picked = ", ".join(f'"{name}"' for name in names)
    expected = [tuple(map(_plain, r)) for r in connection.sql(f"SELECT {picked} FROM ({sql})").fetchall()]
    actual = [tuple(map(_plain, r)) for r in df.select(*(f"`{n}`" for n in names)).collect()]
    if len(expected) != len(actual):
        problems.append(f"rows: expected {len(expected)}, got {len(actual)}")
    expected.sort(key=_sortable)
    actual.sort(key=_sortable)
    wrong = [(e, a) for e, a in zip(expected, actual) if e != a]
    if wrong:
        problems.append(f"{len(wrong)} rows differ in {names}, first: {wrong[0]}")
    return problems


def is_plain_name(name: str) -> bool:
    return re.fullmatch(r"[a-z0-9_]+", name) is not None
