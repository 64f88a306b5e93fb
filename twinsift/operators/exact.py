"""Exact deduplication: all columns, key columns, normalised keys,
fingerprints, and hash-partitioned dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.functions.keys import (
    NORMALIZE_STEPS,
    checksum,
    concat_hash,
    fresh,
    hash64,
    json_fingerprint,
    normalized,
)
from twinsift.operators.survivors import hashable, keep_one
from twinsift.session import scratch_path


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column (NULL equals NULL). Planned as a
    hash aggregate with map-side partial aggregation."""
    return df.dropDuplicates()


def exact_dedup(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    deterministic: bool = True,
) -> DataFrame:
    """Exact deduplication on ``keys`` (all columns when None).

    ``deterministic=False`` is Spark's ``dropDuplicates(keys)``: an arbitrary
    survivor, the cheapest plan. The default keeps the first row in a total
    order, so the survivor never changes between runs.
    """
    if not keys:
        return distinct_rows(df)
    if not deterministic:
        return df.dropDuplicates(list(keys))
    return keep_one(df, list(keys), order_by=order_by)


def normalized_dedup(
    df: DataFrame,
    keys: Sequence[str] = ("name", "email"),
    steps: Sequence[str] = NORMALIZE_STEPS,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Deduplicate on normalised key values; survivors keep original values."""
    return keep_one(df, [normalized(k, steps) for k in keys], order_by=order_by)


def late_dedup(df: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """``exact_dedup`` that moves wide rows only where a key repeats.

    First the 64-bit hashes of the keys alone are counted: eight bytes a row
    are shuffled, whatever the row's width. A row whose hash occurs once is
    unique for certain and goes to the result from where it is read. Only rows
    whose hash occurs again are shuffled whole, and they are compared by their
    keys, so a collision costs a row's way and never a row. The repeated hashes
    are written before they are joined: their size is known when the plan is
    made, and a broadcast is chosen if it allows; beyond that the wide rows are
    shuffled once, as without this.

    ``df`` is read three times, so let it be a table (or ``cut_lineage``)."""
    names = list(keys or df.columns)
    hash_ = fresh("__hash", df)
    hashed = df.withColumn(hash_, F.xxhash64(F.lit(0), *hashable(df, names)))
    repeated = hashed.groupBy(hash_).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(hash_)
    path = scratch_path(df.sparkSession, "repeated")
    repeated.write.parquet(path)
    repeated = df.sparkSession.read.schema(repeated.schema).parquet(path)
    once = hashed.join(repeated, hash_, "left_anti").drop(hash_)
    again = hashed.join(repeated, hash_, "left_semi").drop(hash_)
    return once.unionByName(exact_dedup(again, keys, order_by))


FINGERPRINTS = ("md5", "sha256", "concat_md5", "json_md5", "xxhash64")


def fingerprint(columns: Sequence[str], kind: str = "md5"):
    if kind in ("md5", "sha256"):
        return checksum(columns, kind)
    if kind == "concat_md5":
        return concat_hash(columns)
    if kind == "json_md5":
        return json_fingerprint(columns)
    if kind == "xxhash64":
        return hash64(columns)
    raise ValueError(f"fingerprint kind must be one of {FINGERPRINTS}, got {kind!r}")


def fingerprint_dedup(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    kind: str = "md5",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Deduplicate on a fingerprint of ``columns`` (all columns when None).

    ``md5``/``sha256`` write NULL as ``''``; ``concat_md5`` skips NULLs;
    ``json_md5`` is delimiter-safe. ``xxhash64`` is only a prefilter: rows
    are grouped by (hash, key values), so a collision never drops a row.
    """
    columns = list(columns or df.columns)
    if kind == "xxhash64":
        return keep_one(df, [hash64(columns), *columns], order_by=order_by)
    return keep_one(df, [fingerprint(columns, kind)], order_by=order_by)


def partitioned_dedup(
    df: DataFrame,
    keys: Sequence[str],
    num_partitions: int = 100,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key, hash-partitioned by the keys into ``num_partitions``.

    The rows are reduced first (``keep_one`` limits each key's rows before its
    shuffle), so a key that holds a third of all rows is one row by the time
    that rows are dealt out; the result has the promised partitioning."""
    keys = list(keys)
    return keep_one(df, keys, order_by=order_by).repartition(num_partitions, *keys)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def fillna_dedup(df: DataFrame, fill: dict, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Replace NULLs by constants, then deduplicate on ``keys``."""
    return exact_dedup(df.fillna(fill), keys, order_by=order_by)
