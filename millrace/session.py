"""Session settings and the shared folder that multi-step jobs write to."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # static sizes count compressed files; nothing that grows should be broadcast by mistake
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # a side whose every shuffled partition is below this is hashed instead of sorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 << 20),
    # landing folders hold many small files: pack them into few tasks
    "spark.sql.files.openCostInBytes": str(1 << 20),
    # recording the call site of every column doubles the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "millrace",
    master: str | None = None,
    *,
    input_bytes: int | None = None,
    cores: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the library's settings; given the size of the input and the cores, with partitions to match."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes, cores or 8) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for a given input size and number of cores.

    Shuffle partitions start at 128 MB of input each, at every size, and AQE joins
    the small ones; scan splits grow with the input so that 100 TB does not become
    close to a million tiny tasks, and stay small enough to keep all cores busy.
    """
    split = min(max(input_bytes // max(cores * 4, 1), 16 << 20), 512 << 20)
    partitions = max(input_bytes // (128 << 20), cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    }


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A machine-local folder stands in only where the setting is absent and the
    master is local; on a cluster other executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_base()


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, never used before."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh shared folder, removed when the block succeeds.

    After a failure it stays, because it may hold the only full copy of a table.
    """
    folder = workspace(spark, label)
    yield folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write df to a fresh path and read it back.

    For a result that a plan uses twice: the long lineage runs once, and a lost
    executor repeats the read of a small table instead of the whole pipeline.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
