"""Streaming queries: tables replayed as file streams in several arrivals.

Each arrival lands files and runs the stream over what is new
(``availableNow``, one checkpoint), so every query goes through several
batches and restarts. All folders are fresh ones below the shared checkpoint
folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsift.registry import register
from twinsift.registry.sqltext import EVENTS_COLUMNS, keep_one_sql
from twinsift.session import scratch_path
from twinsift.sources.files import write_files
from twinsift.sources.tables import join_path, load
from twinsift.operators.bloom import BloomSpec
from twinsift.plans.sizing import state_stores
from twinsift.streaming.dedup import (
    BloomSeenTableSink,
    SeenTableSink,
    file_arrivals,
    read_parquet_stream,
    run_available,
    within_watermark,
)
from twinsift.streaming.state import first_seen, in_stores, keyed_state

KEYS = ["user_id", "event_type"]
ARRIVALS = 4


def _arrivals(spark, sf_dir, landing):
    """``events`` arriving in ``ARRIVALS`` spans of time, one after the other,
    each with some rows of the span before sent again: a generator that lands
    a span's files and yields (its number, the length of a span in seconds)."""
    events = load(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(seconds), F.max(seconds)).first()
    span = max(1, -(-(hi - lo + 1) // ARRIVALS))
    number = F.coalesce(((seconds - lo) / span).cast("int"), F.lit(0))
    for i in range(ARRIVALS):
        again = (number == i - 1) & (F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0)
        events.filter((number == i) | again).write.mode("append").parquet(landing)
        yield i, span


def _events_stream(spark, sf_dir, landing):
    return read_parquet_stream(spark, landing, load(spark, sf_dir, "events").schema)


def _stores(spark, sf_dir):
    """State stores as ``events`` and the cores ask for."""
    return in_stores(spark, state_stores(spark, join_path(sf_dir, "events.parquet")))


@register("stream_dedup", "SELECT * FROM events")
def q_stream_dedup(spark, sf_dir):
    """Events sent again within the watermark (one span of arrivals) are
    dropped; state older than that is forgotten."""
    base = scratch_path(spark, "stream-dedup")
    with _stores(spark, sf_dir):
        for _, span in _arrivals(spark, sf_dir, f"{base}/in"):
            stream = within_watermark(_events_stream(spark, sf_dir, f"{base}/in"), ["event_id"], "ts", f"{span} seconds")
            run_available(stream, f"{base}/checkpoint", path=f"{base}/out")
    return spark.read.parquet(f"{base}/out")


@register("stream_seen_table", keep_one_sql("events", EVENTS_COLUMNS, KEYS, ["ts"], "first"))
def q_stream_seen_table(spark, sf_dir):
    """foreachBatch: per key the earliest event, appended once to the target,
    over several batches that repeat keys and rows."""
    base = scratch_path(spark, "stream-seen")
    target = f"{base}/target"
    for _ in _arrivals(spark, sf_dir, f"{base}/in"):
        run_available(_events_stream(spark, sf_dir, f"{base}/in"), f"{base}/checkpoint", sink=SeenTableSink(target, KEYS, ["ts"]))
    return spark.read.parquet(target).select(*[F.col(c) for c in EVENTS_COLUMNS])


@register("stream_keyed_state", keep_one_sql("events", EVENTS_COLUMNS, KEYS, ["ts"], "first"))
def q_stream_keyed_state(spark, sf_dir):
    """Keyed state: per key the earliest event passes once, over several
    batches and restarts; keys are held for a day."""
    base = scratch_path(spark, "stream-state")
    with keyed_state(spark), _stores(spark, sf_dir):
        for _ in _arrivals(spark, sf_dir, f"{base}/in"):
            passed = first_seen(_events_stream(spark, sf_dir, f"{base}/in"), KEYS, ["ts"], ttl_seconds=86_400)
            run_available(passed, f"{base}/checkpoint", path=f"{base}/out")
    return spark.read.parquet(f"{base}/out").select(*[F.col(c) for c in EVENTS_COLUMNS])


@register("stream_bloom_seen_table", keep_one_sql("events", EVENTS_COLUMNS, ["user_id"], ["ts"], "first"))
def q_stream_bloom_seen_table(spark, sf_dir):
    """foreachBatch with a Bloom filter of the target's keys as first pass:
    per user the earliest event, appended once. From the second batch on the
    filter is probed."""
    base = scratch_path(spark, "stream-bloom")
    target = f"{base}/target"
    users = load(spark, sf_dir, "events").agg(F.approx_count_distinct("user_id")).first()[0]
    sink = BloomSeenTableSink(target, "user_id", f"{base}/filter", BloomSpec.for_items(max(users, 1) * 2, 0.01), ["ts"])
    for _ in _arrivals(spark, sf_dir, f"{base}/in"):
        run_available(_events_stream(spark, sf_dir, f"{base}/in"), f"{base}/checkpoint", sink=sink)
    return spark.read.parquet(target).select(*[F.col(c) for c in EVENTS_COLUMNS])


@register(
    "stream_file_arrivals",
    "SELECT DISTINCT md5(coalesce(text, '')) AS file_hash, CAST(strlen(coalesce(text, '')) AS BIGINT) AS file_size "
    "FROM documents UNION SELECT md5(''), 0",
)
def q_stream_file_arrivals(spark, sf_dir):
    """Every document arrives as a file of its own, in subfolders and in two
    batches with a restart between them, each with a marker file without bytes;
    files are listed and hashed on the executors and a content is kept once."""
    base = scratch_path(spark, "file-arrivals")
    docs = load(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    target = f"{base}/target"
    for part in range(2):
        arriving = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == part)
        folder = F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("string")
        write_files(arriving, f"{base}/landing", F.concat(F.lit("part-"), folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")), "content")
        write_files(spark.range(1), f"{base}/landing", F.lit(f"arrived-{part}"), F.lit(None).cast("binary"))
        run_available(file_arrivals(spark, f"{base}/landing", recursive=True), f"{base}/checkpoint", sink=SeenTableSink(target, ["file_hash"], ["file_path"]))
    return spark.read.parquet(target).select("file_hash", "file_size")
