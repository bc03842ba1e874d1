"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: One limit for the native memory of all state stores of an executor, instead of one write buffer for each store.
ROCKSDB_BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"

#: Micro-batches of which state is kept, 100 unless set: each version of a book is a whole one.
KEPT_BATCHES = "spark.sql.streaming.minBatchesToRetain"


def build_session(
    app_name: str = "swapbook",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with the settings the package relies on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: both then come from
    spark-submit, and AQE coalesces or splits shuffle partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config(ROCKSDB_BOUNDED, "true")
        # changelog checkpoints upload only what a micro-batch changed, not the whole book
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # state calls of the Python stateful operator go over a socket file, not a TCP port
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # no stack capture per column expression: plans here have hundreds of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory is not None:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = tempfile.mkdtemp(prefix="swapbook-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return os.path.join(shared_dir(spark), f"{purpose}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, where a lost executor cannot take it."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs whose frames are out of use, which it else does when the driver's memory fills."""
    gc.collect()
    spark._jvm.System.gc()
