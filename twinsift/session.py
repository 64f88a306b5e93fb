"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder that iterative operators cut lineage into."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "twinsift") -> SparkSession:
    """A local session configured the way the tests and bench expect.

    On a cluster the caller owns the session; nothing in the library creates one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TWINSIFT_DRIVER_MEMORY", "16g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session with no
    setting (tests) gets a fresh folder of its own; a cluster session with no
    setting is an error, because a machine-local folder is not visible to
    other executors and does not survive their loss.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):  # not local-cluster: its executors are other processes
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="twinsift-ckpt-"))
        return sc.getCheckpointDir()
    raise ValueError("set spark.checkpoint.dir to a shared folder before running iterative operators")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves
    it (local, HDFS or an object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote for passing use."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its Hadoop file system; ``target`` must not exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = a.getFileSystem(conf)
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"can't rename {source} to {target}")


def write_marker(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``, which must not exist."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, False).close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Write ``df`` to the shared checkpoint folder and continue from there.

    The data is persisted while the checkpoint is written (otherwise Spark
    computes the plan twice: once for the job, once for the files), then
    released; the returned DataFrame reads the reliable copy, so losing an
    executor never reaches back past this point.
    """
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
