"""Session helpers: building a local session for tests and finding shared scratch space.

On a cluster the session is handed to us already configured; we only read
``spark.checkpoint.dir`` from it.  A directory of our own is set only when the
session has none (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sylvan")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting a local one only if none is configured.

    A machine-local folder is only acceptable in local mode (tests); on a
    cluster an unset ``spark.checkpoint.dir`` is an error, since executors
    must all see the tables written there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; point it at a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="sylvan-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for tables we write and read back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize_at(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint directory; return (re-read df, path).

    Used to cut lineage in iterative plans (one job, survives executor loss,
    unlike a local checkpoint).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def materialize(df, name: str):
    return materialize_at(df, name)[0]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`materialize_at` once nothing reads it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
