"""Every registered query against its SQL: column types, rows and exact values."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from checks.queries import QUERIES
from checks.sql import SQL
from tests.compare import connect, differences, is_plain_name


@pytest.fixture(scope="module")
def connection(sf_dir):
    with connect(sf_dir) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, sf_dir, name):
    assert differences(queries()[name](spark, sf_dir), connection, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert all(map(is_plain_name, queries()))


def test_entry_has_rows(spark):
    assert entry(spark).count() == 396


def test_known_counts(spark, tiny_dir):
    rows = queries()["build_marts"](spark, tiny_dir).groupBy("model").count().collect()
    assert {r["model"]: r["count"] for r in rows} == {
        "stg_observations": 989,
        "fact_observations": 989,
        "fact_daily_weather": 396,
        "dim_stations": 15,
        "extreme_weather_events": 197,
    }
