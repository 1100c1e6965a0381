"""Tables: create, append, replace, update, delete, and the rows others keep seeing."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.stage import stage_path
from gaugeline.schemas import METRIC_RAW, SAMPLES
from gaugeline.sources import tables


@pytest.fixture
def name(spark):
    namespace = f"t_{uuid.uuid4().hex}"
    tables.create_namespace(spark, namespace, stage_path(spark, "db"))
    tables.create_namespace(spark, namespace)
    return f"{namespace}.t"


def rows(spark, n=20):
    return spark.range(n).select("id", (F.col("id") % 4).alias("part"), F.lit("x").alias("v"))


def make(spark, name, partition_by=()):
    df = rows(spark)
    tables.create_table(spark, name, df.schema, stage_path(spark, "t"), partition_by)
    tables.append_rows(df, name)
    return df


def contents(spark, name):
    return sorted(tuple(r) for r in tables.read_table(spark, name).select("id", "part", "v").collect())


def location(spark, name):
    return tables._location(spark, name).removeprefix("file:")


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_append_matches_columns_by_name(spark, name, partition_by):
    df = make(spark, name, partition_by)
    tables.append_rows(df.select("v", "part", "id"), name)
    assert len(contents(spark, name)) == 40
    assert contents(spark, name)[0] == (0, 0, "x")


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_replace_by_a_selection_from_itself(spark, name, partition_by):
    make(spark, name, partition_by)
    before = location(spark, name)
    tables.replace_rows(tables.read_table(spark, name).filter("id < 6 AND part <> 1"), name)
    assert [r[0] for r in contents(spark, name)] == [0, 2, 3, 4]
    assert os.path.isdir(before)
    tables.drop_old_versions(spark, name)
    assert not os.path.isdir(before)
    assert len(contents(spark, name)) == 4


def test_running_reader_keeps_the_old_rows(spark, name):
    make(spark, name)
    reader = tables.read_table(spark, name).select("id")
    plan_built = reader.count()
    tables.replace_rows(rows(spark, 3), name)
    assert (plan_built, len(contents(spark, name))) == (20, 3)


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_update(spark, name, partition_by):
    make(spark, name, partition_by)
    tables.update_rows(spark, name, {"v": F.lit("new")}, (F.col("part") == 2) & (F.col("id") > 5))
    got = contents(spark, name)
    assert len(got) == 20
    assert {r[0] for r in got if r[2] == "new"} == {6, 10, 14, 18}


def test_update_leaves_other_partitions_alone(spark, name):
    make(spark, name, ("part",))
    def files(part):
        return set(os.listdir(f"{location(spark, name)}/part={part}"))

    before = {part: files(part) for part in range(4)}
    tables.update_rows(spark, name, {"v": F.lit("new")}, F.col("part") == 2)
    assert [part for part in range(4) if files(part) != before[part]] == [2]
    with pytest.raises(ValueError, match="partition columns"):
        tables.update_rows(spark, name, {"part": F.lit(1)}, F.lit(True))


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_delete(spark, name, partition_by):
    make(spark, name, partition_by)
    tables.delete_rows(spark, name, (F.col("part") == 1) | (F.col("id") == 2))
    expected = [i for i in range(20) if i % 4 != 1 and i != 2]
    assert [r[0] for r in contents(spark, name)] == expected
    # An emptied partition must not come back when partitions are listed anew.
    tables.append_rows(rows(spark).filter("id = 0"), name)
    spark.catalog.refreshTable(name)
    assert [r[0] for r in contents(spark, name)] == [0, *expected]


def test_delete_of_nothing(spark, name):
    make(spark, name, ("part",))
    tables.delete_rows(spark, name, F.col("id") > 99)
    assert len(contents(spark, name)) == 20


def test_null_partition(spark, name):
    df = rows(spark).withColumn("part", F.when(F.col("part") != 3, F.col("part")))
    tables.create_table(spark, name, df.schema, stage_path(spark, "t"), ("part",))
    tables.append_rows(df, name)
    tables.update_rows(spark, name, {"v": F.lit("new")}, F.col("id") == 3)
    assert {r["id"] for r in tables.read_table(spark, name).filter("v = 'new'").collect()} == {3}
    tables.delete_rows(spark, name, F.col("part").isNull())
    assert tables.read_table(spark, name).count() == 15
    tables.replace_rows(df, name)
    assert tables.read_table(spark, name).count() == 20


def test_replace_partitions(spark, name):
    make(spark, name, ("part",))
    tables.replace_partitions(spark.createDataFrame([(99, 1, "y"), (98, 7, "z")], "id long, part long, v string"), name)
    got = contents(spark, name)
    assert [r for r in got if r[1] in (1, 7)] == [(98, 7, "z"), (99, 1, "y")]
    assert len(got) == 17


def test_recreate_and_declared_types(spark, name):
    folder = stage_path(spark, "t")
    tables.create_table(spark, name, METRIC_RAW, folder)
    tables.create_table(spark, name, METRIC_RAW, folder)
    assert spark.table(name).dtypes == [(f.name, f.dataType.simpleString()) for f in METRIC_RAW]
    tables.recreate_table(spark, name, SAMPLES, folder)
    assert spark.table(name).columns == SAMPLES.names


def test_required_columns_are_enforced(spark, name):
    tables.create_table(spark, name, SAMPLES, stage_path(spark, "t"))
    bad = spark.createDataFrame([(None, None, "n", 1.0, ["a"])], "id int, timestamp timestamp, name string, temperature double, tags array<string>")
    with pytest.raises(Exception, match="NULL"):
        tables.append_rows(bad, name)


def test_reader_in_the_middle_of_a_replace_sees_all_old_rows(spark, name, monkeypatch):
    make(spark, name, ("part",))
    seen = []
    write = tables._write_version

    def then_read(df, path, parts):
        write(df, path, parts)
        seen.append(len(contents(spark, name)))

    monkeypatch.setattr(tables, "_write_version", then_read)
    tables.replace_rows(rows(spark, 3), name)
    assert seen == [20] and len(contents(spark, name)) == 3


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_unknown_columns_and_unsafe_types_raise_before_writing(spark, name, partition_by):
    make(spark, name, partition_by)
    before = location(spark, name)
    writers = [tables.append_rows, tables.replace_rows] + [tables.replace_partitions] * bool(partition_by)
    for write in writers:
        with pytest.raises(ValueError, match="more"):
            write(rows(spark).withColumn("more", F.lit(1)), name)
        with pytest.raises(ValueError, match="'v'"):
            write(rows(spark).drop("v"), name)
        with pytest.raises(ValueError, match="types of.*id"):
            write(rows(spark).withColumn("id", F.lit("x")), name)
    assert len(contents(spark, name)) == 20 and location(spark, name) == before
    tables.append_rows(rows(spark, 1).withColumn("id", F.lit(7).cast("int")), name)
    assert len(contents(spark, name)) == 21


def test_safe_types():
    from pyspark.sql import types as T

    assert tables._holds(T.LongType(), T.IntegerType()) and not tables._holds(T.IntegerType(), T.LongType())
    assert tables._holds(T.DoubleType(), T.IntegerType()) and not tables._holds(T.FloatType(), T.IntegerType())
    assert tables._holds(T.TimestampType(), T.DateType()) and not tables._holds(T.StringType(), T.LongType())


def test_save_mart_takes_new_columns_types_and_partitions(spark, name):
    folder = stage_path(spark, "mart")
    tables.save_mart(rows(spark), name, folder, ("part",))
    tables.save_mart(rows(spark, 5).withColumn("b", F.lit(1.5)).withColumn("id", F.col("id").cast("string")), name, folder)
    table = tables.read_table(spark, name)
    assert table.dtypes == [("id", "string"), ("part", "bigint"), ("v", "string"), ("b", "double")]
    assert table.count() == 5


def test_view_follows_its_table(spark, name):
    make(spark, name)
    tables.save_view(spark, f"{name}_view", f"SELECT id FROM {name} WHERE part = 1")
    assert spark.table(f"{name}_view").count() == 5
    tables.replace_rows(rows(spark, 2), name)
    assert spark.table(f"{name}_view").count() == 1
    tables.drop_namespace(spark, name.split(".")[0])
    assert not spark.catalog.databaseExists(name.split(".")[0])


def test_save_mart_creates_and_replaces(spark, name):
    folder = stage_path(spark, "mart")
    tables.save_mart(rows(spark), name, folder, ("part",))
    tables.save_mart(rows(spark, 5), name, folder, ("part",))
    assert [r[0] for r in contents(spark, name)] == [0, 1, 2, 3, 4]
