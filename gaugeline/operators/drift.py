"""How JSON documents differ from the schema they are read with.

Reading with a declared schema drops fields it does not know and turns values of
another type into NULL, both without a word. Here the documents are read as
VARIANT once and grouped by their shape; documents of a shape have the same
fields and types, so one of each is enough to list them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators.stage import stage

KNOWN, UNKNOWN, OTHER, UNSEEN, UNREADABLE = "known", "unknown field", "other type", "never seen", "unreadable"

# Levels of objects and lists that are listed.
DEPTH = 8

# Kinds of JSON values that a column of a type takes unchanged; text takes every scalar.
_SCALARS = ["integer", "number", "string", "boolean"]
_TAKEN = {
    "tinyint": ["integer"],
    "smallint": ["integer"],
    "int": ["integer"],
    "bigint": ["integer"],
    "float": ["integer", "number"],
    "double": ["integer", "number"],
    "boolean": ["boolean"],
    "string": _SCALARS,
    "timestamp": ["string"],
    "timestamp_ntz": ["string"],
    "date": ["string"],
}


def _taken(kind: T.DataType) -> list[str]:
    if isinstance(kind, (T.StructType, T.MapType)):
        return ["object"]
    if isinstance(kind, T.ArrayType):
        return ["array"]
    return _TAKEN.get(kind.simpleString(), _SCALARS)


def declared_fields(schema: T.DataType, path: str = "") -> list[tuple[str, list[str]]]:
    """(path, kinds it takes) of all fields of a schema; the elements of a list are ``path[]``."""
    if isinstance(schema, T.ArrayType):
        return [(f"{path}[]", _taken(schema.elementType)), *declared_fields(schema.elementType, f"{path}[]")]
    if not isinstance(schema, T.StructType):
        return []
    found = []
    for field in schema:
        name = f"{path}.{field.name}" if path else field.name
        found += [(name, _taken(field.dataType)), *declared_fields(field.dataType, name)]
    return found


def _kind(value: Column) -> Column:
    """integer, number, string, boolean, object, array or null."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "BIGINT", "integer")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "number")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "VOID", "null")
        .otherwise("string")
    )


def shapes(documents: DataFrame, column: str) -> DataFrame:
    """Each shape of the JSON texts in ``column`` once: shape, an example and the number of documents.

    One pass; what is shuffled is a row per task and shape. Texts that are no JSON have the shape NULL.
    """
    return (
        documents.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("example"), F.schema_of_variant(F.try_parse_json(column)).alias("shape"))
        .groupBy("shape")
        .agg(F.min_by("example", F.length("example")).alias("example"), F.count(F.lit(1)).alias("documents"))
    )


def schema_drift(documents: DataFrame, column: str, schema: T.StructType, depth: int = DEPTH) -> DataFrame:
    """Fields of the JSON texts in ``column`` held against ``schema``: path, kind, documents, status.

    - known: the field is declared and its kind fits
    - other type: it is declared, but would be read as NULL
    - unknown field: it is not declared and would be dropped
    - never seen: it is declared and no document has it
    - unreadable: the texts that are no JSON, with an empty path

    A field of several kinds has a row for each; JSON's null fits everything. NULL
    texts are no documents.
    """
    spark = documents.sparkSession
    found = stage(shapes(documents, column), "shapes")
    level = found.filter(F.col("shape").isNotNull()).select(
        "shape", "documents", F.lit("").alias("path"), F.try_parse_json("example").alias("value")
    )
    listed = None
    for _ in range(depth):
        inner = level.filter(_kind(F.col("value")).isin("object", "array")).withColumnsRenamed(
            {"value": "_whole", "path": "_path"}
        )
        inside = inner.lateralJoin(spark.tvf.variant_explode(F.col("_whole").outer()))
        below = F.when(F.col("key").isNull(), F.concat("_path", F.lit("[]"))).otherwise(
            F.when(F.col("_path") == "", F.col("key")).otherwise(F.concat_ws(".", "_path", "key"))
        )
        level = inside.select("shape", "documents", below.alias("path"), "value")
        fields = level.select("shape", "documents", "path", _kind(F.col("value")).alias("kind"))
        listed = fields if listed is None else listed.unionByName(fields)
    counted = listed.distinct().groupBy("path", "kind").agg(F.sum("documents").alias("documents"))

    declared = spark.createDataFrame(
        [(path, kinds) for path, kinds in declared_fields(schema)], "_declared string, _kinds array<string>"
    )
    both = counted.join(declared, F.col("path") == F.col("_declared"), "full_outer")
    fits = (F.col("kind") == "null") | F.array_contains("_kinds", F.col("kind"))
    status = (
        F.when(F.col("_declared").isNull(), UNKNOWN).when(F.col("path").isNull(), UNSEEN).when(fits, KNOWN).otherwise(OTHER)
    )
    report = both.select(
        F.coalesce("path", "_declared").alias("path"),
        "kind",
        F.coalesce("documents", F.lit(0).cast("long")).alias("documents"),
        status.alias("status"),
    )
    unread = found.filter(F.col("shape").isNull()).select(
        F.lit("").alias("path"), F.lit(None).cast("string").alias("kind"), "documents", F.lit(UNREADABLE).alias("status")
    )
    return report.unionByName(unread)
