"""Registered queries: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import adapter
from checks.adapter import staged, table
from gaugeline.functions.rounding import round_to
from gaugeline.functions.text import after_marker, last_segment
from gaugeline.operators import chains, drift, mutate, quality, sketches, spread
from gaugeline.operators.ordering import number_rows
from gaugeline.operators.skew import null_safe_join
from gaugeline.operators.stage import stage, stage_path
from gaugeline.operators.zscore import group_spread
from gaugeline.plans import analytics, load, marts, refresh, runstats, staging
from gaugeline.schemas import METRIC_RAW
from gaugeline.sources import clustered, landed, tables
from gaugeline.streaming import dedup, deliveries, ingest, rollup

Query = Callable[[SparkSession, str], DataFrame]

# Group size above which the "_split" queries take the path for hot groups.
SPLIT_ROWS = 50


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({name: round_to(F.col(name), places) for name in names})


def _zoneless(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


# --- models -----------------------------------------------------------------


def stg_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


def _fact(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return marts.fact_observations(staged(spark, sf_dir), ["event_id"], **options)


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_weather(marts.with_time_parts(staged(spark, sf_dir)))


def dim_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.station_dimension(staged(spark, sf_dir))


def extreme_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The staged rows hold the same temperatures as the fact and need no numbering.
    spread = group_spread(staged(spark, sf_dir), "station_id", "temperature_degC")
    events = marts.extreme_events(_fact(spark, sf_dir), spread)
    return _rounded(events, 6, "avg_temp", "stddev_temp", "temp_z_score")


def classify_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = marts.classify(staged(spark, sf_dir)).select(
        "event_id", "station_id", "temp_z_score", "temperature_category"
    )
    return _rounded(scored, 6, "temp_z_score")


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = staging.from_metric(adapter.metric_raw(spark, sf_dir))
    return staging.union_sources(staged(spark, sf_dir, ()), metric)


def build_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging as a view, four models as tables, and the rows of all five."""
    namespace, folder = f"obs_{uuid.uuid4().hex}", stage_path(spark, "marts")
    tables.create_namespace(spark, namespace, folder)

    def save(name: str, df: DataFrame) -> DataFrame:
        tables.save_mart(df, f"{namespace}.{name}", f"{folder}/{name}")
        return tables.read_table(spark, f"{namespace}.{name}")

    save("raw_observations", adapter.imperial_raw(spark, sf_dir))
    view = staging.imperial_view(f"{namespace}.raw_observations", ("event_id",))
    tables.save_view(spark, f"{namespace}.stg_observations", view)
    observations = tables.read_table(spark, f"{namespace}.stg_observations")
    fact = save("fact_observations", marts.fact_observations(observations, ["event_id"]))
    # The first version has other columns and fewer rows.
    save("fact_daily_weather", marts.daily_weather(fact.filter("observation_hour < 6")).drop("avg_pressure_mb"))
    daily = save("fact_daily_weather", marts.daily_weather(fact))
    stations = save("dim_stations", marts.station_dimension(observations))
    extreme = save("extreme_weather_events", marts.extreme_events(fact))

    def rows(model: str, df: DataFrame, moment: str, number: str, reading) -> DataFrame:
        return df.select(
            F.lit(model).alias("model"),
            "station_id",
            F.col(moment).cast("timestamp_ntz").alias("moment"),
            F.col(number).cast("long").alias("number"),
            reading.alias("reading"),
        )

    time, celsius = "observation_timestamp", F.col("temperature_degC")
    result = staging.union_sources(
        rows("stg_observations", observations, time, "event_id", celsius),
        rows("fact_observations", fact, time, "observation_id", celsius),
        rows("fact_daily_weather", daily, "observation_date", "observation_count", F.col("avg_pressure_mb")),
        rows("dim_stations", stations, "first_observation", "total_observations", F.lit(None).cast("double")),
        rows("extreme_weather_events", extreme, time, "observation_id", round_to(F.col("temp_z_score"), 6)),
    )
    return _kept(spark, namespace, result)


# --- analytical queries -----------------------------------------------------


def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.full_scan(table(spark, sf_dir, "lineitem"))


def count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.count_rows(landed.read_footers(spark, f"{sf_dir}/lineitem.parquet"))


def filtered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.filtered_scan(
        table(spark, sf_dir, "events"), "view", "2024-01-08", "2024-01-15", "event_type", "ts"
    )


def daily_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.daily_aggregation(
        adapter.charged(spark, sf_dir),
        key="l_suppkey",
        time="l_shipdate",
        temperature="charge",
        humidity="l_discount",
        wind="l_quantity",
        pressure="l_tax",
    )


def anomaly_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.anomaly_detection(staged(spark, sf_dir), row_key="event_id")
    return _rounded(found, 6, "avg_temp", "stddev_temp", "temp_z_score")


def station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    dimension = analytics.station_dimension(
        placed.withColumn("reading", F.col("o_totalprice") / 7.0),
        ("c_custkey", "c_name", "c_nationkey"),
        "o_orderdate",
        "reading",
    )
    return _rounded(dimension, 6, "avg_temp")


def rolling_avg(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Over humidity, which staging does not round."""
    rolled = analytics.rolling_24(staged(spark, sf_dir), tie=("event_id",), value="humidity_pct", **options)
    return _rounded(rolled, 6, "rolling_24h_avg")


def rolling_24h_range(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Over the last 24 hours, whatever the number of rows."""
    rolled = analytics.rolling_day(staged(spark, sf_dir), ("event_id",), value="humidity_pct", **options)
    return _rounded(rolled, 6, "rolling_24h_avg")


def rolling_avg_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_avg(spark, sf_dir, stations=["ST1", "ST2", "ST3"])


def monthly_percentiles(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    result = analytics.monthly_percentiles(
        adapter.charged(spark, sf_dir),
        key="l_suppkey",
        time="l_shipdate",
        temperature="charge",
        wind="l_extendedprice",
        precipitation="l_tax",
        humidity="l_discount",
        humid_above=0.05,
        **options,
    )
    return _rounded(result, 4, "median_temp", "p95_wind", "avg_temp_humid")


def approx_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations per condition by sketches stored per day and united, beside the exact number."""
    rows = marts.with_time_parts(staged(spark, sf_dir))
    path = stage_path(spark, "distinct-sketches")
    sketches.distinct_sketches(rows, ["condition", "observation_date"], "station_id").write.parquet(path)
    united = sketches.united_sketches(spark.read.parquet(path), ["condition"])
    exact = rows.groupBy("condition").agg(F.count_distinct("station_id").alias("stations"))
    off = F.abs(sketches.distinct_estimate(F.col("sketch")) - F.col("stations"))
    return united.join(exact, "condition").select(
        "condition", "n_rows", "stations", (off <= sketches.distinct_error() * F.col("stations")).alias("within")
    )


def approx_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles by sketches stored per supplier and day and merged by month, with their ranks."""
    rows = adapter.charged(spark, sf_dir).select(
        "l_suppkey", F.to_date("l_shipdate").alias("day"), F.month("l_shipdate").cast("long").alias("month"), "charge"
    )
    path = stage_path(spark, "quantile-sketches")
    sketches.quantile_sketches(rows, ["l_suppkey", "month", "day"], ["charge"]).write.parquet(path)
    merged = sketches.merged_quantiles(spark.read.parquet(path), ["l_suppkey", "month"])
    shares = {"median": 0.5, "p95": 0.95}
    found = merged.select(
        "l_suppkey", "month", *(sketches.sketched_percentile("charge", p).alias(n) for n, p in shares.items())
    )
    ranked = null_safe_join(rows, stage(found, "percentiles"), ["l_suppkey", "month"], "inner")

    def within(name: str, p: float):
        below, upto = F.avg((F.col("charge") < F.col(name)).cast("int")), F.avg((F.col("charge") <= F.col(name)).cast("int"))
        error = sketches.rank_error()
        return ((below <= p + error) & (upto >= p - error)).alias(f"{name}_within")

    return ranked.groupBy("l_suppkey", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), *(within(n, p) for n, p in shares.items())
    )


def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With readings that staging does not round."""
    stats = analytics.load_stats(staged(spark, sf_dir), value="humidity_pct")
    return _rounded(stats, 6, "avg_temp_degC")


def latest_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["observation_timestamp", "station_id", "temperature_degC", "wind_speed_mps", "humidity_pct"]
    return analytics.latest(staged(spark, sf_dir), columns, tie=("event_id",))


def numbered_orders(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Orders numbered by date: many rows share an instant."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, "o_orderdate", ["o_orderkey"], "order_number", **options)


# --- documents --------------------------------------------------------------


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        load.json_field(F.col("props"), "k").alias("k"),
        load.json_field(F.col("props"), "missing").alias("missing"),
    )


def features_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    observation = F.col("observation")
    return adapter.features(spark, sf_dir).select(
        observation["id"].alias("observation_id"),
        observation["properties"]["stationId"].alias("station_id"),
        observation["properties"]["temperature"]["value"].cast("double").alias("temperature"),
    )


def _flat(df: DataFrame) -> DataFrame:
    joined = F.array_join("geometry_coordinates", ",")
    return _zoneless(df.withColumn("geometry_coordinates", joined), "observation_timestamp")


def flatten_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = load.flatten_observations(adapter.features(spark, sf_dir))
    return _flat(quality.apply_contract(flat, METRIC_RAW))


def load_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to a contract-checked table partitioned by day, read back; rejects are landed."""
    good, rejects = load.load_observations(adapter.feature_documents(spark, sf_dir))
    landed.land_rejects(rejects, stage_path(spark, "rejects"))
    dated = good.withColumn("observation_day", F.to_date("observation_timestamp"))
    namespace, name = _new_table(spark, dated, ("observation_day",))
    tables.append_rows(dated, name)
    return _kept(spark, namespace, _flat(tables.read_table(spark, name).drop("observation_day")))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded and rejects by reason, of documents with faults."""
    good, rejects = load.load_observations(adapter.feature_documents(spark, sf_dir, faulty=True))
    path = stage_path(spark, "rejects")
    landed.land_rejects(rejects, path)
    counted = landed.reject_counts(spark.read.schema("reason string, record string").parquet(path))
    loaded = good.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("loaded").alias("reason"), "row_count")
    return counted.unionByName(loaded)


# What is known of the properties of events.
PROPERTIES = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("note", T.StringType()),
        T.StructField("sensor", T.StructType([T.StructField("model", T.StringType())])),
    ]
)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and types of documents that their schema does not know."""
    return drift.schema_drift(adapter.drifting_documents(spark, sf_dir), "document", PROPERTIES)


def load_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults counted while documents are written, beside the rows read back."""
    path = stage_path(spark, "observations")
    counts = load.land_observations(adapter.feature_documents(spark, sf_dir, faulty=True), path)
    written = load.read_marked(spark, path)
    read = written.agg(
        F.count_if("accepted").alias("loaded"), F.count_if(~F.col("accepted")).alias("rejected")
    ).unpivot([], ["loaded", "rejected"], "measure", "rows_read")
    counted = spark.createDataFrame(sorted(counts.items()), "measure string, row_count long")
    return counted.join(read, "measure", "left")


def station_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.page_stations(adapter.station_documents(spark, sf_dir))


def page_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    following = landed.page_cursors(adapter.station_documents(spark, sf_dir))
    return following.withColumn("cursor", after_marker(F.col("next_page"), "page="))


def page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the order of their chains, and where chains break."""
    return chains.follow_chain(*adapter.linked_pages(spark, sf_dir))


def chain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.chain_summary(page_chain(spark, sf_dir))


def url_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", last_segment(F.col("url")).alias("station_id")
    )


# --- marts by increments -----------------------------------------------------

# Landings of events in the order they come: two in time order, then late rows of all days.
LANDINGS = 3


def _landing(time: str = "observation_timestamp"):
    late = F.col("event_id") % 7 == 0
    return F.when(late, 2).when(F.col(time) < F.lit("2024-01-16").cast("timestamp_ntz"), 0).otherwise(1)


def _landings(df: DataFrame) -> list[DataFrame]:
    return [df.filter(_landing() == number) for number in range(LANDINGS)]


def refresh_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart after three landings, each of which touches some of its days."""
    rows = stage(refresh.with_day(marts.with_time_parts(staged(spark, sf_dir))), "observations")
    namespace, name = _new_table(spark, rows, ("day",))
    mart = f"{namespace}.daily"
    model = refresh.with_day(marts.daily_weather(rows.limit(0)), "observation_date")
    tables.create_table(spark, mart, model.schema, stage_path(spark, "daily-mart"), ("day",))
    for landing in _landings(rows):
        tables.append_rows(landing, name)
        refresh.refresh_daily(spark, name, mart, landing)
    return _kept(spark, namespace, tables.read_table(spark, mart).drop("day"))


def fact_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers after three landings, the second of which brings rows of the first again."""
    rows = stage(staged(spark, sf_dir), "observations")
    first, second, late = _landings(rows)
    model = refresh.with_day(marts.fact_observations(rows.limit(0), ["event_id"], keep=("event_id",)))
    namespace, name = _new_table(spark, model, ("day",))
    again = first.filter("event_id % 5 = 0")
    for landing in (first, second.unionByName(again), late, late):
        refresh.fact_increment(spark, name, landing, ["event_id"], ["event_id"])
    return _kept(spark, namespace, tables.read_table(spark, name).drop("day"))


def daily_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation per station from pieces stored per station and day."""
    path = stage_path(spark, "daily-spread")
    dated = marts.with_time_parts(staged(spark, sf_dir))
    spread.spread_pieces(dated, ["station_id", "observation_date"], "temperature_degC").write.parquet(path)
    merged = spread.finished_spread(spread.merge_spread(spark.read.parquet(path), ["station_id"]))
    return _rounded(merged, 6, "avg_temp", "stddev_temp")


# --- tables and changes -----------------------------------------------------


def _new_table(
    spark: SparkSession, df: DataFrame, partition_by: tuple[str, ...] = ()
) -> tuple[str, str]:
    """A namespace and in it an empty table with the columns of ``df``."""
    namespace, folder = f"obs_{uuid.uuid4().hex}", stage_path(spark, "table")
    tables.create_namespace(spark, namespace, folder)
    name = f"{namespace}.observations"
    tables.create_table(spark, name, df.schema, f"{folder}/observations", partition_by)
    return namespace, name


def _kept(spark: SparkSession, namespace: str, result: DataFrame) -> DataFrame:
    """``result`` out of its tables, which go."""
    kept = stage(result, "result")
    tables.drop_namespace(spark, namespace)
    return kept


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    namespace, name = _new_table(spark, orders)
    tables.append_rows(orders.filter("o_orderstatus = 'F'"), name)
    tables.append_rows(orders.filter("o_orderstatus <> 'F'"), name)
    return _kept(spark, namespace, tables.read_table(spark, name))


def overwrite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a table by a selection from itself."""
    orders = table(spark, sf_dir, "orders")
    namespace, name = _new_table(spark, orders)
    tables.append_rows(orders, name)
    tables.replace_rows(tables.read_table(spark, name).filter("o_totalprice > 100000"), name)
    return _kept(spark, namespace, tables.read_table(spark, name))


def overwrite_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace all partitions of a table at once, by fewer of them."""
    events = _dated_events(spark, sf_dir)
    namespace, name = _new_table(spark, events, ("day",))
    tables.append_rows(events, name)
    tables.replace_rows(tables.read_table(spark, name).filter("day > '2024-01-10' AND value > 20"), name)
    return _kept(spark, namespace, tables.read_table(spark, name))


def replace_mart_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart saved again with another column, another type and other partitions."""
    orders = table(spark, sf_dir, "orders")
    namespace, folder = f"obs_{uuid.uuid4().hex}", stage_path(spark, "mart")
    tables.create_namespace(spark, namespace, folder)
    name = f"{namespace}.orders"
    tables.save_mart(orders.drop("o_orderpriority"), name, f"{folder}/orders", ("o_orderstatus",))
    changed = orders.withColumns(
        {"urgent": F.col("o_orderpriority") == "1-URGENT", "o_custkey": F.col("o_custkey").cast("string")}
    )
    tables.save_mart(changed, name, f"{folder}/orders")
    return _kept(spark, namespace, tables.read_table(spark, name))


def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutate.update_where(
        table(spark, sf_dir, "orders"),
        {"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": F.lit("X")},
        F.col("o_orderpriority") == "1-URGENT",
    )


def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutate.delete_where(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")


def _dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPDATE on a table partitioned by day."""
    events = _dated_events(spark, sf_dir)
    namespace, name = _new_table(spark, events, ("day",))
    tables.append_rows(events, name)
    wrong = (F.col("event_type") == "error") & (F.col("day") >= "2024-01-20")
    tables.update_rows(spark, name, {"value": F.col("value") + 1}, wrong)
    return _kept(spark, namespace, tables.read_table(spark, name))


def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELETE on a table partitioned by day; it empties some days and thins out others."""
    events = _dated_events(spark, sf_dir)
    namespace, name = _new_table(spark, events, ("day",))
    tables.append_rows(events, name)
    old = F.col("day") < "2024-01-05"
    tables.delete_rows(spark, name, old | (F.col("value") > 100))
    return _kept(spark, namespace, tables.read_table(spark, name))


def replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace some days of a table; the other days stay."""
    events = _dated_events(spark, sf_dir)
    namespace, name = _new_table(spark, events, ("day",))
    tables.append_rows(events, name)
    recent = events.filter(F.col("day") >= "2024-01-20")
    tables.replace_partitions(recent.withColumn("value", F.lit(0.0)), name)
    return _kept(spark, namespace, tables.read_table(spark, name))


def incremental_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events not among those landed before a date."""
    events = table(spark, sf_dir, "events")
    done = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return mutate.not_yet_landed(events, done, ["event_id"])


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "landed")
    landed.write_landed(table(spark, sf_dir, "orders"), path)
    return landed.read_observations(spark, path)


def managed_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    namespace, name = _new_table(spark, supplier)
    tables.append_rows(supplier, name)
    return _kept(spark, namespace, tables.read_table(spark, name))


def weather_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with a list column through a declared table, then the warm ones."""
    samples = staged(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("observation_timestamp").alias("timestamp"),
        F.col("station_id").alias("name"),
        F.col("temperature_degC").alias("temperature"),
        F.array("location", "condition").alias("tags"),
    )
    namespace, name = _new_table(spark, samples)
    tables.append_rows(samples, name)
    listed = tables.read_table(spark, name).withColumn("tags", F.array_join("tags", ","))
    warm = analytics.warm_samples(listed, ["id", "name", "tags"], "timestamp", "temperature")
    return _kept(spark, namespace, warm)


def _clustered(spark: SparkSession, sf_dir: str, hot_rows: int) -> tuple[str, str]:
    namespace, folder = f"obs_{uuid.uuid4().hex}", stage_path(spark, "clustered")
    tables.create_namespace(spark, namespace, folder)
    name = f"{namespace}.observations"
    rows = staged(spark, sf_dir)
    clustered.save_clustered(
        rows, name, f"{folder}/observations", "station_id", "observation_timestamp", hot_rows, bucket_rows=1_000
    )
    return namespace, name


def clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one station of a clustered table."""
    namespace, name = _clustered(spark, sf_dir, 4_000_000)
    return _kept(spark, namespace, clustered.read_key(spark, name, "station_id", "ST7"))


def clustered_rollup(spark: SparkSession, sf_dir: str, hot_rows: int = 4_000_000) -> DataFrame:
    """The station dimension from a clustered table; with few ``hot_rows`` some stations are hot."""
    namespace, name = _clustered(spark, sf_dir, hot_rows)
    return _kept(spark, namespace, clustered.by_key(spark, name, marts.station_dimension))


# --- quality ----------------------------------------------------------------


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapter.imperial_raw(spark, sf_dir)
    return quality.not_null_violations(raw, ["station", "observation_time", "temperature_f"])


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unaccepted_values(
        table(spark, sf_dir, "events"), "event_type", ["click", "view", "purchase"]
    )


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    return quality.reconcile_counts(items, orders, ["order_key"])


def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns cast to a declared schema; rows with an unreadable required value set aside."""
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType(), False),
            T.StructField("k", T.IntegerType(), False),
            T.StructField("event_type", T.StringType()),
        ]
    )
    text = table(spark, sf_dir, "events").select(
        "event_type",
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(load.json_field(F.col("props"), "k"))
        .alias("k"),
    )
    good, aside = quality.split_required(quality.apply_contract(text, schema), schema)
    return good.withColumn("accepted", F.lit(True)).unionByName(
        aside.withColumn("accepted", F.lit(False))
    )


# --- timings ----------------------------------------------------------------


def run_stats(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _rounded(runstats.run_stats(adapter.timings(spark, sf_dir), **options), 4, "median", "p95")


def overhead_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = runstats.overhead_report(
        runstats.run_stats(adapter.timings(spark, sf_dir)), "view", "click"
    )
    return _rounded(report, 4, "base_median", "other_median")


def mean_overhead(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = runstats.run_stats(adapter.timings(spark, sf_dir))
    return runstats.mean_overhead(runstats.overhead_report(stats, "view", "click"))


def result_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings written as JSON without their raw samples, read back."""
    stats = run_stats(spark, sf_dir).withColumn("raw_times", F.array("min", "max"))
    path = stage_path(spark, "report")
    runstats.export_report(stats, path)
    columns = "median double, p95 double, runs long, mean double, min double, max double, stddev double"
    return spark.read.schema(f"query long, format string, {columns}").json(path)


# --- streams ----------------------------------------------------------------


def _landed_events(spark: SparkSession, df: DataFrame) -> tuple[str, T.StructType]:
    path = stage_path(spark, "landed-events")
    landed.write_landed(df.repartition(6), path)
    return path, df.schema


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a landing folder that grows in between."""
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    path, schema = _landed_events(spark, events.filter(F.col("ts") < middle))
    target, checkpoint = stage_path(spark, "ingested"), stage_path(spark, "ingest-checkpoint")
    stream = ingest.file_stream(spark, path, schema, files_per_batch=2)
    ingest.append_stream(stream, target, checkpoint)
    events.filter(F.col("ts") >= middle).write.mode("append").parquet(path)
    ingest.append_stream(stream, target, checkpoint)
    return spark.read.schema(schema).parquet(target)


def _staged_stream(spark: SparkSession, path: str, schema: T.StructType, files: int | None) -> DataFrame:
    raw = ingest.file_stream(spark, path, schema, files_per_batch=files)
    return staging.from_imperial(raw).withColumn(
        "observation_timestamp", F.col("observation_timestamp").cast("timestamp")
    )


def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches in time order, which cut days in two; the first two are merged."""
    raw = adapter.imperial_raw(spark, sf_dir)
    target, checkpoint = stage_path(spark, "daily"), stage_path(spark, "daily-checkpoint")
    path = stage_path(spark, "landed-events")
    cuts = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-09 07:00:00", "2024-01-21 13:00:00")]
    number = sum((F.coalesce(F.col("observation_time") >= cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for batch in range(3):
        raw.filter(number == batch).write.mode("append").parquet(path)
        stream = _staged_stream(spark, path, raw.schema, None)
        rollup.land_windowed(stream, "2 days", target, checkpoint)
        if batch == 1:
            rollup.merge_batches(spark, target, windowed=True)
    return _zoneless(rollup.read_windowed(spark, target), "observation_date")


def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of two files in any order; they are merged, and a second run adds nothing."""
    target, checkpoint = stage_path(spark, "partials"), stage_path(spark, "partials-checkpoint")
    path, schema = _landed_events(spark, adapter.imperial_raw(spark, sf_dir))
    stream = marts.with_time_parts(_staged_stream(spark, path, schema, 2))
    rollup.land_partials(stream, target, checkpoint)
    rollup.merge_batches(spark, target)
    rollup.land_partials(stream, target, checkpoint)
    return _zoneless(rollup.read_partials(spark, target), "observation_date")


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies by the mean and deviation of pieces that three runs of a stream left; two are merged."""
    rows = stage(staged(spark, sf_dir), "observations")
    target, checkpoint = stage_path(spark, "spread"), stage_path(spark, "spread-checkpoint")
    path = stage_path(spark, "landed-events")
    stored = ["station_id", "location"]
    for number, landing in enumerate(_landings(rows)):
        landing.write.mode("append").parquet(path)
        stream = ingest.file_stream(spark, path, rows.schema)
        rollup.land_spread(stream, stored, "temperature_degC", target, checkpoint)
        if number == 1:
            rollup.merge_batches(spark, target, merge=rollup.added_spread(stored))
    known = rollup.read_spread(spark, target, ["station_id"])
    found = analytics.anomaly_detection(rows, row_key="event_id", spread=known)
    return _rounded(found, 6, "avg_temp", "stddev_temp", "temp_z_score")


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of three runs: rows again, some of them too late, then late rows of all days."""
    events = stage(table(spark, sf_dir, "events"), "events")
    first, second, late = (events.filter(_landing("ts") == number) for number in range(LANDINGS))
    path, target, checkpoint = (stage_path(spark, n) for n in ("landed-events", "deliveries", "deliveries-checkpoint"))
    for landing in (first, second.unionByName(first.filter("event_id % 5 = 0")), late.unionByName(late.limit(0))):
        landing.write.mode("append").parquet(path)
        stream = ingest.file_stream(spark, path, events.schema)
        deliveries.land_deliveries(stream, ["event_id"], "ts", 2 * 86_400, target, checkpoint)
    counts = deliveries.read_counts(spark, target)
    times = deliveries.read_landed(spark, target, stream).agg(
        F.count(F.lit(1)).alias("landed_rows"), F.count_distinct("event_id").alias("landed_keys")
    )
    return counts.join(times)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which the purchases are delivered twice."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    again = events.filter("event_type = 'purchase'")
    path, schema = _landed_events(spark, events.unionByName(again))
    target, checkpoint = stage_path(spark, "dedup"), stage_path(spark, "dedup-checkpoint")
    stream = ingest.file_stream(spark, path, schema)
    ingest.append_stream(
        dedup.first_deliveries(stream, ["event_id"], "ts", "2 days"), target, checkpoint
    )
    return _zoneless(spark.read.schema(schema).parquet(target), "ts")


QUERIES: dict[str, Query] = {
    "stg_observations": stg_observations,
    "fact_observations": _fact,
    "fact_observations_split": partial(_fact, hot_rows=10),
    "daily_weather": daily_weather,
    "dim_stations": dim_stations,
    "extreme_events": extreme_events,
    "classify_observations": classify_observations,
    "union_sources": union_sources,
    "build_marts": build_marts,
    "full_scan": full_scan,
    "count_star": count_star,
    "filtered_scan": filtered_scan,
    "daily_aggregation": daily_aggregation,
    "anomaly_detection": anomaly_detection,
    "station_dimension": station_dimension,
    "rolling_avg": rolling_avg,
    "rolling_avg_split": partial(rolling_avg, hot_rows=SPLIT_ROWS),
    "rolling_avg_stations": rolling_avg_stations,
    "rolling_24h_range": rolling_24h_range,
    "rolling_24h_range_split": partial(rolling_24h_range, hot_rows=SPLIT_ROWS),
    "approx_stations": approx_stations,
    "approx_percentiles": approx_percentiles,
    "monthly_percentiles": monthly_percentiles,
    "monthly_percentiles_split": partial(monthly_percentiles, hot_rows=5),
    "load_stats": load_stats,
    "latest_observations": latest_observations,
    "numbered_orders": numbered_orders,
    "numbered_orders_split": partial(numbered_orders, hot_rows=5),
    "json_extract": json_extract,
    "features_explode": features_explode,
    "flatten_observations": flatten_observations,
    "load_observations": load_observations,
    "load_rejects": load_rejects,
    "load_quality": load_quality,
    "schema_drift": schema_drift,
    "station_pages": station_pages,
    "page_cursor": page_cursor,
    "page_chain": page_chain,
    "chain_report": chain_report,
    "url_key": url_key,
    "refresh_daily": refresh_daily,
    "fact_increment": fact_increment,
    "daily_spread": daily_spread,
    "append_rows": append_rows,
    "overwrite_rows": overwrite_rows,
    "overwrite_partitioned": overwrite_partitioned,
    "replace_mart_schema": replace_mart_schema,
    "update_where": update_where,
    "delete_where": delete_where,
    "update_rows": update_rows,
    "delete_rows": delete_rows,
    "replace_partitions": replace_partitions,
    "incremental_anti": incremental_anti,
    "parquet_roundtrip": parquet_roundtrip,
    "managed_table_scan": managed_table_scan,
    "weather_samples": weather_samples,
    "clustered_scan": clustered_scan,
    "clustered_rollup": clustered_rollup,
    "clustered_rollup_split": partial(clustered_rollup, hot_rows=SPLIT_ROWS + 15),
    "not_null_violations": not_null_violations,
    "duplicate_keys": duplicate_keys,
    "accepted_values": accepted_values,
    "reconcile_counts": reconcile_counts,
    "schema_contract": schema_contract,
    "run_stats": run_stats,
    "run_stats_split": partial(run_stats, hot_rows=15),
    "overhead_report": overhead_report,
    "mean_overhead": mean_overhead,
    "result_export": result_export,
    "stream_ingest": stream_ingest,
    "stream_daily": stream_daily,
    "stream_rollup": stream_rollup,
    "stream_anomalies": stream_anomalies,
    "stream_late": stream_late,
    "stream_dedup": stream_dedup,
}
