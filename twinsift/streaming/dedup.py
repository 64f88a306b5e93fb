"""Deduplication of data as it arrives (Structured Streaming).

* ``within_watermark``: drop repeats of a key seen within the event-time
  watermark; state is bounded by the watermark, older keys are forgotten.
* ``SeenTableSink``: a ``foreachBatch`` sink that keeps one row per key of
  each micro-batch and appends only keys the target table does not hold.
  It never forgets; a replayed batch appends nothing twice, because its keys
  are already in the target.
* ``BloomSeenTableSink``: the same with a Bloom filter table as first pass;
  only rows the filter cannot rule out are checked against the target.
* ``file_arrivals``: files picked up as they land, hashed on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from twinsift.operators import bloom
from twinsift.operators.files import hash_listed
from twinsift.operators.incremental import unseen_rows
from twinsift.operators.survivors import keep_one
from twinsift.session import path_exists, remove_path
from twinsift.sources.files import stream_files


def read_parquet_stream(
    spark: SparkSession, folder: str, schema: StructType, glob: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of ``folder`` as a stream (an explicit schema, as
    streaming file sources require)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def within_watermark(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop rows whose key already appeared within ``delay`` of event time.

    A watermark needs a TIMESTAMP column; a TIMESTAMP_NTZ event time is read
    as a session-time-zone timestamp in a hidden column."""
    if isinstance(stream.schema[ts].dataType, TimestampNTZType):
        timed = stream.withColumn("__event_time", F.col(ts).cast("timestamp"))
        out = timed.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark(list(keys))
        return out.drop("__event_time")
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


class SeenTableSink:
    """``foreachBatch`` sink: per batch keep one row per key (first in
    ``order_by``), drop keys already in the Parquet table at ``target``,
    append the rest."""

    def __init__(self, target: str, keys: Sequence[str], order_by: Sequence[str] = ()):
        self.target = target
        self.keys = list(keys)
        self.order_by = list(order_by)

    def new_rows(self, batch: DataFrame, batch_id: int = 0) -> DataFrame:
        spark = batch.sparkSession
        fresh = keep_one(batch, self.keys, order_by=self.order_by)
        if path_exists(spark, self.target):
            # written first: its size is known when the plan is made, so the target's keys are cut to the batch's
            # where they are read (a broadcast, if that size allows) and only what is left of them is shuffled
            fresh = self._stage(fresh, batch_id, "candidates")
            fresh = unseen_rows(spark.read.parquet(self.target), fresh, self.keys, reduce_existing=True, null_safe=True)
        return fresh

    def _staged(self, batch_id: int) -> str:
        return f"{self.target}.staged/batch={batch_id}"

    def _stage(self, rows: DataFrame, batch_id: int, name: str) -> DataFrame:
        """Materialise rows of the batch before touching the target, so the
        append does not read the table it writes."""
        stage = f"{self._staged(batch_id)}/{name}"
        rows.write.mode("overwrite").parquet(stage)
        return rows.sparkSession.read.schema(rows.schema).parquet(stage)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._stage(self.new_rows(batch, batch_id), batch_id, "rows").write.mode("append").parquet(self.target)
        remove_path(batch.sparkSession, self._staged(batch_id))


class BloomSeenTableSink(SeenTableSink):
    """``SeenTableSink`` with a Bloom filter of the target's keys (single key
    column) kept next to it, one folder a batch: a batch reads the newest
    complete one and writes its own, so no crash leaves half a filter. Rows the filter
    rules out skip the comparison with the target; the result is the same."""

    def __init__(self, target: str, key: str, filter_path: str, spec: bloom.BloomSpec, order_by: Sequence[str] = ()):
        super().__init__(target, [key], order_by)
        self.key = key
        self.filter_path = filter_path
        self.spec = spec

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = keep_one(batch, self.keys, order_by=self.order_by)
        version = self.newest(spark, batch_id)
        filt = None if version is None else spark.read.parquet(self._version(version))
        if filt is not None and path_exists(spark, self.target):
            target = spark.read.parquet(self.target).select(self.key)
            # only target keys among the batch's 'maybe' keys are compared; NULL is a key that no filter holds
            fresh = self._stage(fresh, batch_id, "candidates")
            maybe = self._stage(bloom.maybe_keys(fresh, self.key, filt, self.spec), batch_id, "maybe")
            seen = target.join(maybe, self.key, "left_semi").unionByName(target.filter(F.col(self.key).isNull()).limit(1))
            fresh = unseen_rows(seen, fresh, self.key, null_safe=True)
        rows = self._stage(fresh, batch_id, "rows")
        # the filter learns the batch's keys BEFORE they reach the target: a
        # batch replayed in between sees "maybe" and is checked exactly
        added = bloom.build(rows, self.key, self.spec)
        merged = added if filt is None else bloom.merge(filt, added)
        if version != batch_id:  # a replayed batch finds its version complete
            merged.write.mode("overwrite").parquet(self._version(batch_id))
        rows.write.mode("append").parquet(self.target)
        remove_path(spark, self._staged(batch_id))
        if version is not None and version < batch_id:
            remove_path(spark, self._version(version))

    def _version(self, batch_id: int) -> str:
        return f"{self.filter_path}/batch={batch_id}"

    def newest(self, spark: SparkSession, batch_id: int) -> int | None:
        """The latest batch whose filter was written to its end."""
        return next((b for b in range(batch_id, -1, -1) if path_exists(spark, f"{self._version(b)}/_SUCCESS")), None)


def file_arrivals(
    spark: SparkSession, folder: str, hash_type: str = "md5", glob: str | None = None, recursive: bool = False, **options
) -> DataFrame:
    """Stream of arriving files (those without bytes too) as ``file_path,
    file_name, file_size, file_hash``, hashed in chunks on the executors; pair
    with ``SeenTableSink(target, ['file_hash'])``. ``options`` are those of
    ``sources.listing``."""
    return hash_listed(stream_files(spark, folder, glob, recursive, **options), hash_type).drop("error")


def run_available(stream: DataFrame, checkpoint: str, sink=None, path: str | None = None, output_mode: str = "append"):
    """Process everything available now, then stop (``availableNow``)."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    if sink is not None:
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format("parquet").option("path", path)
    query = writer.start()
    query.awaitTermination()
    return query
