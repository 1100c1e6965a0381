"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Overflowing sums raise instead of wrapping around.
    "spark.sql.ansi.enabled": "true",
    # Saves a stack capture for every column expression built in Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Counts and bounds of whole tables from file footers, for version 2 scans.
    "spark.sql.parquet.aggregatePushdown": "true",
    # State of streaming aggregations off the heap, with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Bytes one task should read or receive, so that its sort mostly stays in memory.
TASK_BYTES = 128 * 1024 * 1024

_local_scratch: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(
    app: str = "gaugeline",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 8,
    **conf: str,
) -> SparkSession:
    """A session with the settings the library expects; ``conf`` adds or overrides.

    With ``input_bytes`` shuffles and scans are sized for that input on ``cores``.
    """
    sized = sized_for(input_bytes, cores) if input_bytes else {}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a cluster of ``cores`` that reads ``input_bytes`` of Parquet.

    Shuffles start with enough partitions for rows twice their compressed size;
    AQE merges the small ones, but cannot split a partition before a sort.
    """
    partitions = max(2 * cores, 2 * input_bytes // TASK_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(min(partitions, 100_000)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
    }


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: on a
    cluster a machine-local folder would be lost together with its executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_scratch:
        folder = tempfile.TemporaryDirectory(prefix="gaugeline-", ignore_cleanup_errors=True)
        _local_scratch[context.applicationId] = folder  # removed when the process ends
    return _local_scratch[context.applicationId].name
