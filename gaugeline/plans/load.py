"""Loading landed documents into the observations table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.quality import apply_contract, contract_faults, fault_names, split_contract
from gaugeline.schemas import MEASURES, METRIC_RAW
from gaugeline.sources.landed import CORRUPT, explode_features, unreadable_documents


def flatten_observations(features: DataFrame, *keep: str) -> DataFrame:
    """One 22-column row per ``observation`` struct; a missing field is NULL.

    Time and readings are the landed text, for the contract to cast. ``keep`` names
    further columns to carry along.
    """
    source = F.col("observation")
    properties = source["properties"]

    def reading(name: str) -> Column:
        return properties[name]["value"]

    return features.select(
        *keep,
        properties["timestamp"].alias("observation_timestamp"),
        source["id"].alias("observation_id"),
        source["type"].alias("observation_type"),
        source["geometry"]["type"].alias("geometry_type"),
        source["geometry"]["coordinates"].alias("geometry_coordinates"),
        reading("elevation").alias("elevation_m"),
        properties["stationId"].alias("station_id"),
        properties["stationName"].alias("station_name"),
        *(reading(field).alias(name) for name, field in MEASURES.items()),
    )


def json_field(document: Column, path: str) -> Column:
    """A field of a JSON text as text; NULL where it is absent."""
    return F.get_json_object(document, f"$.{path}")


def load_observations(collections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the table's schema, rejects) of landed documents.

    Rejects are unreadable documents, rows without a required value and rows with a
    value that does not convert, each with its reason and its text.
    """
    rows = flatten_observations(explode_features(collections))
    good, rejects = split_contract(rows, METRIC_RAW)
    return good, rejects.unionByName(unreadable_documents(collections))


# Reason of a document that could not be read.
UNREADABLE = "unreadable document"


def land_observations(collections: DataFrame, path: str) -> dict[str, int]:
    """Write documents to ``path`` in one pass over them, counting faults on the way; returns the counts.

    Rows land in the folders ``accepted=true``, with the columns of the
    table, and ``accepted=false``, with their reason and text as well: rejects are
    unreadable documents, rows without a required value and rows with a value
    that does not convert, as in ``load_observations``. The counts are those of
    rows written: ``loaded``, ``rejected`` and every fault that occurred; a row
    with two faults counts for both.
    """
    observation = F.when(F.col(CORRUPT).isNull(), F.col("features"))
    rows = collections.select(CORRUPT, F.explode_outer(observation).alias("observation"))
    rows = rows.filter(F.col(CORRUPT).isNotNull() | F.col("observation").isNotNull())
    flat = flatten_observations(rows, CORRUPT)
    broken = F.col(CORRUPT).isNotNull()
    names = [field.name for field in METRIC_RAW]
    marked = flat.withColumns(
        {
            "faults": F.when(broken, F.array(F.lit(UNREADABLE))).otherwise(contract_faults(METRIC_RAW)),
            "record": F.when(broken, F.col(CORRUPT)).otherwise(F.to_json(F.struct(*names))),
        }
    )
    accepted = F.size("faults") == 0
    counted = Observation()
    every = {f"fault_{i}": name for i, name in enumerate([UNREADABLE, *fault_names(METRIC_RAW)])}
    observed = marked.observe(
        counted,
        F.count_if(accepted).alias("loaded"),
        F.count_if(~accepted).alias("rejected"),
        *(F.count_if(F.array_contains("faults", name)).alias(alias) for alias, name in every.items()),
    )
    landed = apply_contract(observed, METRIC_RAW, ("faults", "record")).select(
        *names,
        F.when(~accepted, F.array_join("faults", "; ")).alias("reason"),
        F.when(~accepted, F.col("record")).alias("record"),
        accepted.alias("accepted"),
    )
    landed.write.partitionBy("accepted").parquet(path)
    found = counted.get
    faults = {name: found[alias] for alias, name in every.items() if found[alias]}
    return {"loaded": found["loaded"], "rejected": found["rejected"]} | faults


def read_marked(spark: SparkSession, path: str) -> DataFrame:
    """What ``land_observations`` wrote: good rows, and rejects with ``reason`` and ``record``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in METRIC_RAW)
    return spark.read.schema(f"{fields}, reason string, record string, accepted boolean").parquet(path)
