"""Spark session helpers: the configuration the jobs are written against."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# SQL settings the jobs are written against (all runtime-settable, applied
# to a given session by ``configure``).  Static broadcast is off because the
# planner's size estimate of a join output is the product of its inputs
# (no CBO), which makes a large fact look small; AQE instead broadcasts a
# join side only when its *measured* shuffle output is under 32 MB.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}

# Settings every job assumes.  AQE coalesces small shuffle partitions and
# splits skewed join partitions at run time; the session zone is fixed so
# that date functions give the same answer on every executor.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "supplyscope",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with ``BASE_CONF`` applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    if not any(k == "spark.driver.memory" for k in (extra or {})):
        # only takes effect when this call starts the JVM (local tools, tests)
        b = b.config("spark.driver.memory", "8g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to a session created elsewhere."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session (tests, the bench) gets a folder of our own when it is unset; a
    cluster without the setting is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
        d = tempfile.mkdtemp(prefix="supplyscope-ckpt-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def output_root(spark: SparkSession, name: str) -> str:
    """A folder for written tables, next to the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


#: Spark's setting that removes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``df`` as parquet.  The shuffles of the write, whose plan runs this
    once, are removed behind it instead of when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path, compression=compression)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``written``, for the length of a block; its files are emptied behind it."""
    path = f"{output_root(df.sparkSession, 'work')}/{name}-{uuid.uuid4().hex}"
    store(df, path, "zstd")
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    df.sparkSession.range(0).write.mode("overwrite").parquet(path)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a parquet table of its own in the shared folder, read back."""
    path = f"{output_root(df.sparkSession, 'work')}/{name}-{uuid.uuid4().hex}"
    store(df, path, compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
