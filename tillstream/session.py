"""Session construction and the shared staging folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tillstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    `conf` keys may use `__` for dots; `**sized_for(...)` fits it to the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        # Call sites in error messages cost a third of the time it takes to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs whose largest shuffle moves about `shuffle_bytes` on `cores` cores.

    Starts with partitions of about 256 MiB, which fit in an executor's execution memory without
    spilling, and lets adaptive execution merge the small ones. Streams keep the number of
    partitions they were first started with.
    """
    partitions = max(math.ceil(shuffle_bytes / (256 << 20)), 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; it must be reachable by every executor."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    import tempfile

    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillstream-"))
    return context.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage (lost executors re-read files instead of recomputing) and makes every later
    reader see the very same rows, also where the plan is not deterministic.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
