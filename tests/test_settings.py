"""Session settings, the scratch folder and storage locations."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from gaugeline.operators import stage as staging
from gaugeline.session import TASK_BYTES, build_session, scratch_dir, sized_for
from gaugeline.sources.locations import storage_conf, warehouse_path


def session(master: str, folder: str | None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=master))


def test_shuffles_grow_with_the_input():
    assert sized_for(10**6, 8)["spark.sql.shuffle.partitions"] == "16"
    assert sized_for(1000 * TASK_BYTES, 8)["spark.sql.shuffle.partitions"] == "2000"
    assert sized_for(10**14, 4000)["spark.sql.shuffle.partitions"] == "100000"


def test_a_session_is_sized_for_its_input(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        build_session("gaugeline-tests", input_bytes=100 * TASK_BYTES, cores=4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for key in sized_for(1, 1):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_shared_folder_wins():
    assert scratch_dir(session("yarn", "s3a://bucket/scratch/")) == "s3a://bucket/scratch"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("spark://host:7077", None))


def test_local_mode_may_use_a_temporary_folder():
    first = scratch_dir(session("local[2]", None))
    assert os.path.isdir(first) and scratch_dir(session("local[2]", None)) == first


def test_stages_do_not_share_paths(spark):
    assert staging.stage_path(spark, "x") != staging.stage_path(spark, "x")


def test_settle_stages_only_what_may_be_large(spark, monkeypatch):
    small = spark.range(10)
    assert staging.settle(small, "s") is small
    monkeypatch.setattr(staging, "SMALL_BYTES", 8)
    settled = staging.settle(small, "s")
    assert settled is not small and settled.inputFiles()
    assert settled.count() == 10


def test_delete_path(spark):
    path = staging.stage_path(spark, "gone")
    spark.range(3).write.parquet(path)
    staging.delete_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_locations():
    assert warehouse_path("local", root="/data/") == "file:///data/warehouse"
    assert warehouse_path("s3", "/w/", bucket="b") == "s3a://b/w"
    assert (
        warehouse_path("azure", storage_account="acc", container="c")
        == "abfss://c@acc.dfs.core.windows.net/warehouse"
    )
    assert warehouse_path("gcs", bucket="b") == "gs://b/warehouse"
    with pytest.raises(ValueError, match="backend"):
        warehouse_path("ftp")
    with pytest.raises(KeyError):
        warehouse_path("s3")


def test_storage_conf():
    assert storage_conf("gcs") == {}
    conf = storage_conf("s3", region="eu-west-1", endpoint_url="http://minio")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio"
    assert conf["spark.hadoop.fs.s3a.endpoint.region"] == "eu-west-1"
