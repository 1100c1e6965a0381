"""The given tables seen as observations.

``events`` is the observation stream; the same expressions stand in the SQL of
``checks.sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.rounding import round_to
from gaugeline.operators.stage import stage_path
from gaugeline.plans.load import json_field
from gaugeline.plans.staging import from_imperial
from gaugeline.sources.landed import explode_features, page_links, read_feature_collections, read_station_pages

# Features in one landed collection, at most.
PAGE_ROWS = 500

# Declared, so that no job reads footers to infer them.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id long, url string, html string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _measure_k() -> Column:
    return json_field(F.col("props"), "k").cast("double")


def imperial_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as °F readings. Every 97th has no time, every 89th no temperature."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("ST"), F.col("user_id")).alias("station"),
        F.concat(F.lit("L"), F.col("user_id") % 5).alias("location"),
        F.when(F.col("event_id") % 97 != 0, F.col("ts")).alias("observation_time"),
        F.when(F.col("event_id") % 89 != 0, F.col("value")).alias("temperature_f"),
        (_measure_k() + F.col("value") / 7.0).alias("humidity_pct"),
        round_to(F.col("value") / 4.0, 2).alias("wind_speed_mph"),
        (F.lit(1013.25) - F.col("value") / 7.0).alias("pressure_mb"),
        F.col("event_type").alias("condition"),
    )


def staged(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    return from_imperial(imperial_raw(spark, sf_dir), keep)


def feature_documents(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    """Events as GeoJSON collections of one station, read back from landed JSON text.

    Event ids are unique, so a page holds at most ``PAGE_ROWS`` of them. ``faulty``
    documents have text for the temperature of errors, no station for every 97th
    event, and end too early for every 50th user.
    """
    temperature, station = F.col("value"), F.concat(F.lit("ST"), F.col("user_id"))
    if faulty:
        temperature = F.when(F.col("event_type") == "error", "n/a").otherwise(temperature.cast("string"))
        station = F.when(F.col("event_id") % 97 != 0, station)

    def reading(value: Column) -> Column:
        return F.struct(value.alias("value"))

    k = _measure_k()
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    feature = F.struct(
        F.format_string("obs-%d", "event_id").alias("id"),
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.format_string("-%d.50", F.col("user_id") % 180), F.lit("40.640")).alias(
                "coordinates"
            ),
        ).alias("geometry"),
        F.struct(
            F.concat(F.regexp_replace(stamp, " ", "T"), F.lit("+00:00")).alias("timestamp"),
            station.alias("stationId"),
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("stationName"),
            reading(F.col("user_id") % 100).alias("elevation"),
            reading(temperature).alias("temperature"),
            reading(F.when(k > 50, k)).alias("windSpeed"),
            reading(k).alias("relativeHumidity"),
        ).alias("properties"),
    )
    pages = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.floor(F.col("event_id") / PAGE_ROWS).alias("page"))
        .agg(F.collect_list(feature).alias("features"))
        .select("user_id", F.to_json(F.struct("features")).alias("value"))
    )
    whole = F.col("value")
    if faulty:
        whole = F.when(F.col("user_id") % 50 == 0, F.expr("left(value, length(value) - 9)")).otherwise(whole)
    pages = pages.select(whole.alias("value"))
    path = stage_path(spark, "landed-features")
    pages.write.text(path)
    return read_feature_collections(spark, path, one_per_file=False)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_features(feature_documents(spark, sf_dir))


def station_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs as station pages, read back from landed JSON text; URLs without ``page=`` end a chain."""
    url = F.col("url")
    document = F.struct(
        F.array(url).alias("observationStations"),
        F.struct(F.when(url.contains("page="), url).alias("next")).alias("pagination"),
    )
    path = stage_path(spark, "landed-pages")
    table(spark, sf_dir, "pages").select(F.to_json(document).alias("value")).write.text(path)
    return read_station_pages(spark, path, one_per_file=False)


def linked_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(links, starts) of chains of fifty pages, read back from landed JSON text.

    Each page names the page of the next id. In every third chain one leads back, in
    every second one leads to a page that was not landed.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.col("page_id")
    target = F.when(number % 50 == 49, None).when(number % 150 == 110, number - 7).otherwise(number + 1)
    following = pages.select(number.alias("target"), F.col("url").alias("following"))
    linked = pages.withColumn("target", target).join(following, "target", "left")
    document = F.struct(
        F.col("url").alias("page"),
        F.array("url").alias("observationStations"),
        F.struct(
            F.when(number % 100 == 20, F.concat("url", F.lit("/gone"))).otherwise(F.col("following")).alias("next")
        ).alias("pagination"),
    )
    path = stage_path(spark, "landed-chain")
    linked.select(F.to_json(document).alias("value")).write.text(path)
    starts = pages.filter(number % 50 == 0).select(F.col("url").alias("page"))
    return page_links(read_station_pages(spark, path, one_per_file=False)), starts


def drifting_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events; some have fields or types of their own, some end too early."""
    number, k = F.col("event_id"), _measure_k().cast("int")
    changed = (
        F.when(number % 40 == 0, F.expr("left(props, length(props) - 1)"))
        .when(number % 25 == 0, F.format_string('{"k": %d, "sensor": {"model": "m%d", "rev": 2}}', k, k))
        .when(number % 15 == 0, F.format_string('{"k": "%d"}', k))
        .when(number % 10 == 0, F.format_string('{"unit": "C", "k": %d}', k))
        .when(number % 9 == 0, F.format_string('{"k": %d.5, "tags": ["a", 1, "b"]}', k))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select(changed.alias("document"))


def charged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with ``charge``, a reading of many decimals."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").withColumn("charge", charge)


def metric_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as metric readings, keyed by supplier."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("SU"), F.col("l_suppkey")).alias("station_id"),
        F.col("l_returnflag").alias("station_name"),
        F.col("l_shipdate").alias("observation_timestamp"),
        F.col("l_quantity").alias("temperature_degC"),
        (F.col("l_discount") * 1000.0).alias("relative_humidity_percent"),
        F.col("l_quantity").alias("wind_speed_kmh"),
        F.col("l_extendedprice").alias("barometric_pressure_Pa"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timings of a user's query in as many formats as there are types."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("query"),
        F.col("event_type").alias("format"),
        (F.col("value") / 7.0).alias("time_ms"),
    )
