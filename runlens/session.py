"""Session helpers: configuration, shared scratch space and size estimates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Below this many estimated input bytes rows are dealt over all cores before heavy work on each.
SMALL_INPUT_BYTES = 256 * 1024 * 1024
# Stored input bytes for one partition of a shuffle; sorted rows take some twenty times as much memory.
PARTITION_BYTES = 8 * 1024 * 1024
# Spark's estimate for sources of unknown size is far above this.
UNKNOWN_BYTES = 1 << 60


def build_session(master: str | None = None, name: str = "runlens", **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Call-site capture doubles the time to build large expressions.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster.

    Only a local session may fall back to a folder of this machine; on a
    cluster an unset ``spark.checkpoint.dir`` is an error, because executors
    could not see a driver-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="runlens-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df``; no job is started."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def partitions_by_size(df: DataFrame) -> list[int]:
    """The number of partitions to shuffle ``df`` into, as a list to put before the columns; empty leaves it to Spark.

    A fixed number makes the share, and so the memory, of a task grow with the
    input. Larger inputs get a partition for each ``PARTITION_BYTES`` of what
    they are read from; sources of unknown size, as lists of the driver, do not count.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    needed = sum(s for s in sizes if s < UNKNOWN_BYTES) // PARTITION_BYTES + 1
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [needed] if needed > usual else []


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a small input over all cores before heavy per-row work.

    One small file is one task, however much work each row takes. Large inputs
    have splits enough and are left as they are.
    """
    if estimated_bytes(df) > SMALL_INPUT_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
