"""Time the headline queries and print one JSON line.

Each query is built and written to Spark's ``noop`` sink, which computes every
row and column without storing them: one warm-up, then the median of the runs.
``queries`` run on the given tables. ``wide`` runs the analytical queries on line
items in the 22-column layout, in several files, at two sizes: the folder of the
tables and ten times its rows, with rows per second.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.queries import QUERIES
from gaugeline.operators.stage import clear_stages, stage_path
from gaugeline.plans import analytics
from gaugeline.session import build_session
from gaugeline.schemas import METRIC_RAW
from gaugeline.sources.landed import read_footers

HEADLINE = [
    "full_scan",
    "count_star",
    "filtered_scan",
    "daily_aggregation",
    "anomaly_detection",
    "station_dimension",
    "rolling_avg",
    "monthly_percentiles",
    "stg_observations",
    "fact_observations",
    "daily_weather",
    "dim_stations",
    "extreme_events",
    "load_stats",
    "latest_observations",
]

# The analytical queries on line items in the 22-column layout.
OBSERVATIONS = {
    "full_scan": analytics.full_scan,
    "count_star": analytics.count_rows,
    "filtered_scan": lambda df: analytics.filtered_scan(df, "SU7", "1995-01-01", "1996-01-01"),
    "daily_aggregation": analytics.daily_aggregation,
    "anomaly_detection": analytics.anomaly_detection,
    "station_dimension": analytics.station_dimension,
    "window_function": lambda df: analytics.rolling_24(df, ["SU1", "SU2", "SU3"]),
    "multi_join_aggregation": analytics.monthly_percentiles,
}


def wide_rows(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """Line items as readings of suppliers; copies are shifted by an hour each."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("*", numbers)
    hours = F.make_interval(hours=F.col("l_linenumber") + F.col("copy").cast("int"))
    readings = {
        "observation_timestamp": (F.col("l_shipdate") + hours).cast("timestamp"),
        "observation_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "copy"),
        "station_id": F.concat(F.lit("SU"), F.col("l_suppkey")),
        "station_name": F.concat(F.lit("SU"), F.col("l_suppkey")),
        "elevation_m": F.col("l_suppkey").cast("double"),
        "temperature_degC": F.col("l_quantity") + F.col("l_discount") + F.col("copy") / 8,
        "wind_speed_kmh": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "precipitation_3h_mm": F.col("l_tax"),
        "relative_humidity_percent": F.col("l_discount") * 1000,
        "barometric_pressure_Pa": F.col("l_extendedprice") * (1 + F.col("l_tax")),
    }
    missing = F.lit(None)
    return items.select(*(readings.get(f.name, missing).cast(f.dataType).alias(f.name) for f in METRIC_RAW))


def _wide_times(spark: SparkSession, sf_dir: str, copies: int, files: int, runs: int) -> dict:
    path = stage_path(spark, "wide")
    wide_rows(spark, sf_dir, copies).repartition(files).write.parquet(path)
    rows = spark.read.schema(METRIC_RAW).parquet(path)
    count = rows.count()
    sources = {"count_star": read_footers(spark, path)}
    times = {
        name: _median_time(lambda: query(sources.get(name, rows)), runs) for name, query in OBSERVATIONS.items()
    }
    return {"rows": count, "files": files, "sec": times, "rows_per_sec": {n: round(count / t) for n, t in times.items()}}


def _median_time(build: Callable[[], DataFrame], runs: int) -> float:
    taken = []
    for _ in range(runs + 1):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - started)
    return round(statistics.median(taken[1:]), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
    }
    spark = build_session("gaugeline-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    try:
        times = {name: _median_time(lambda: QUERIES[name](spark, sf_dir), runs) for name in HEADLINE}
        files = int(cpus) if cpus.isdigit() else 8
        wide = [_wide_times(spark, sf_dir, copies, files, runs) for copies in (1, 10)]
    finally:
        clear_stages(spark)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "wide": wide,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
