"""Shuffle sizing from the input's bytes. Broadcasts are left to AQE, which
decides from measured sizes."""

from __future__ import annotations

DEFAULT_PARTITION_BYTES = 256 * 1024 * 1024
STORE_BYTES = 32 * 1024 * 1024


def input_bytes(spark, paths) -> int:
    """Total size of the files under ``paths`` from the file system's
    metadata (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in [paths] if isinstance(paths, str) else list(paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        for status in fs.globStatus(hp) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return int(total)


def tune_shuffle(spark, paths, partition_bytes: int = DEFAULT_PARTITION_BYTES, expansion: float = 3.0) -> int:
    """Set ``spark.sql.shuffle.partitions`` so each shuffle partition holds
    about ``partition_bytes`` (compressed input times ``expansion`` for the
    decoded rows), never fewer than the cluster's cores; AQE coalesces the
    small ones and splits skewed ones. Returns the number set."""
    cores = spark.sparkContext.defaultParallelism
    wanted = int(input_bytes(spark, paths) * expansion // max(partition_bytes, 1)) + 1
    n = max(cores, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes // 2))
    return n


def state_stores(spark, paths, store_bytes: int = STORE_BYTES) -> int:
    """How many state stores a stream over the files under ``paths`` gets:
    one for each ``store_bytes`` of them, at least two for each core, and no
    more than the session's ``spark.sql.shuffle.partitions``.

    Every store is loaded at each start and committed in each batch, with new
    keys or without, so stores beyond what the cores and the keys ask for cost
    time; the number is fixed by the checkpoint's first batch."""
    wanted = max(2 * spark.sparkContext.defaultParallelism, input_bytes(spark, paths) // max(store_bytes, 1))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
