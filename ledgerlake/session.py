"""SparkSession construction with the settings this library is tuned for."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings applied when this library builds the session itself. On a cluster
# the session normally comes from the platform; `configure()` then only sets
# the SQL options that are safe to change at runtime.
RUNTIME_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# The JVM does not compile generated methods above 8000 bytes of bytecode, and runs them many
# times slower: wide projections are then better split into one function a few columns. Rows of the
# panels cost far more than their bytes, so that adaptive partitions of 64 MB make tasks of minutes.
WIDE_ROWS_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def build_session(master: str | None = None, app: str = "ledgerlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or get) a session. `master` defaults to `local[*]` only when
    nothing else configured one (tests, bench)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "16g")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in RUNTIME_SQL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_SQL_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def for_wide_rows(spark: SparkSession) -> None:
    """Session settings for frames of many computed columns; they change speed, not results."""
    for k, v in WIDE_ROWS_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - conf not set
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's spark.checkpoint.dir; only when it is unset and all runs
    in this process (local tests) fall back to a fresh scratch folder."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else f"{base.rstrip('/')}/tables/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, through Hadoop's FileSystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within this block, Spark deletes the shuffle files of a query once it has
    ended. For steps that each end in a checkpoint or a written table, so that
    later steps never read those files again, and disk holds one step at a time."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
