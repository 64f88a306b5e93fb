"""Sinks: Parquet overwrite, append of unseen rows only, bucketed tables,
and rewriting a table as its own deduplication.

A job that reads and writes the same location must not be one lazy plan:
the new rows are staged in a fresh folder first, then written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from twinsift.operators.incremental import unseen_rows
from twinsift.session import path_exists, remove_path, rename_path, scratch_path, write_marker


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append_unseen(spark: SparkSession, new: DataFrame, target_path: str, key: str | Sequence[str]) -> int:
    """Append to the Parquet table at ``target_path`` only the new rows whose
    key it does not hold yet (NULL is a key like any other); returns the number
    of rows appended.

    The new rows are written first, so their size is known when the plan is
    made: the table's keys are cut to theirs where they are read, by a
    broadcast if that size allows, and are never shuffled whole."""
    if not path_exists(spark, target_path):
        write_parquet(new, target_path)
        return spark.read.parquet(target_path).count()
    stage = scratch_path(spark, "append-stage")
    write_parquet(new, f"{stage}/new")
    candidates = spark.read.schema(new.schema).parquet(f"{stage}/new")
    rows = unseen_rows(spark.read.parquet(target_path), candidates, key, reduce_existing=True, null_safe=True)
    write_parquet(rows, f"{stage}/rows")
    staged = spark.read.schema(rows.schema).parquet(f"{stage}/rows")
    added = staged.count()
    staged.write.mode("append").parquet(target_path)
    remove_path(spark, stage)
    return added


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int = 100,
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    path: str | None = None,
) -> str:
    """Save as a table bucketed (and sorted) by the keys: later joins and
    deduplication on the keys need no exchange. With ``path`` its files lie
    there and outlive the table's entry in the catalog."""
    writer = df.write.mode(mode).bucketBy(buckets, *keys)
    if path:
        writer = writer.option("path", path)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)
    return table


def rewrite_deduplicated(spark: SparkSession, path: str, dedup_fn) -> str:
    """Replace the Parquet table at ``path`` by ``dedup_fn(table)``.

    The result is written beside the table, then the two are swapped by
    renames, under a marker file that says how far along things are:

    1. the result is complete at ``<path>.swap-new``;
    2. the marker ``<path>.swap`` is made: from here on the new table counts;
    3. the table goes to ``<path>.swap-old``, and the new one to ``path``;
    4. the old table and then the marker are removed.

    Whatever step a crash comes after, the old or the new table is whole, and
    ``recover_rewrite`` (which this calls first) finishes or undoes the swap.
    Renames are single operations on HDFS and local disks; on an object store
    they copy, and the marker makes up for it. One writer at a time."""
    recover_rewrite(spark, path)
    new, marker = _swap_paths(path)[0], _swap_paths(path)[2]
    write_parquet(dedup_fn(spark.read.parquet(path)), new)
    write_marker(spark, marker)
    _finish(spark, path)
    return path


def recover_rewrite(spark: SparkSession, path: str) -> str:
    """Bring a table whose rewrite was cut short to one whole state: ``undone``
    (the result was not complete or not yet counted: the table is as it was),
    ``finished`` (the new table is in place) or ``clean`` (nothing to do)."""
    new, _, marker = _swap_paths(path)
    if path_exists(spark, marker):
        _finish(spark, path)
        return "finished"
    if path_exists(spark, new):
        remove_path(spark, new)
        return "undone"
    return "clean"


def _swap_paths(path: str) -> tuple[str, str, str]:
    base = path.rstrip("/")
    return f"{base}.swap-new", f"{base}.swap-old", f"{base}.swap"


def _finish(spark: SparkSession, path: str) -> None:
    """The steps after the marker, each only if it wasn't done."""
    new, old, marker = _swap_paths(path)
    if path_exists(spark, new):
        if path_exists(spark, path):
            # a copying rename that broke off may have left part of the old table there; ``path`` is still whole then
            remove_path(spark, old)
            rename_path(spark, path, old)
        rename_path(spark, new, path)
    remove_path(spark, old)
    remove_path(spark, marker)
    spark.catalog.refreshByPath(path)
