"""Incremental deduplication: keep only the new rows whose key has not been
seen in the existing data.

The core is a left-anti join against the DISTINCT existing keys: the
distinct runs with partial aggregation, so a key repeated in a third of the
existing rows is one row by the time it is shuffled. A NULL key never
matches, so new rows with NULL keys are kept. Repeats inside the new data
survive; ``keep_one`` first when they must not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.functions.keys import checksum, fresh
from twinsift.operators.survivors import keep_one


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def unseen_rows(
    existing: DataFrame, new: DataFrame, key: str | Sequence[str] = "email", reduce_existing: bool = False, null_safe: bool = False
) -> DataFrame:
    """New rows whose key does not occur in ``existing``.

    ``reduce_existing`` is for a small batch against a large table: the
    existing keys are first cut to the batch's keys by a semi join (AQE
    broadcasts the batch's keys when their runtime size allows), so the large
    side is filtered where it is read instead of being shuffled whole.
    ``null_safe`` takes NULL for a key value like any other (a NULL key that
    exists already is seen)."""
    keys = _keys(key)
    seen = existing.select(*keys)

    def matches(other: DataFrame, name: str, of: DataFrame):
        """``other``'s keys under names that ``of`` lacks, and the join condition."""
        names = [fresh(f"{name}{i}", of) for i in range(len(keys))]
        same = [of[k].eqNullSafe(F.col(n)) if null_safe else of[k] == F.col(n) for k, n in zip(keys, names, strict=True)]
        return other.toDF(*names), same

    if reduce_existing:
        seen = seen.join(*matches(new.select(*keys).distinct(), "__batch", seen), "left_semi")
    return new.join(*matches(seen.distinct(), "__seen", new), "left_anti")


def incremental_report(existing: DataFrame, new: DataFrame, key: str | Sequence[str] = "email") -> DataFrame:
    """One row: existing_rows, new_rows, unseen_rows, already_seen_rows.

    Each input is read once: one aggregate over the existing keys gives both
    the distinct keys and the existing row count; one left join marks the new
    rows whose key was seen (a NULL key never is)."""
    from twinsift.operators.reports import _combine

    keys = _keys(key)
    count, there = fresh("__c", existing), fresh("__seen", existing, new)
    per_key = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    ex = per_key.agg(F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("existing_rows"))
    marked = new.select(*keys).join(per_key.select(*keys, F.lit(1).alias(there)), keys, "left")
    nw = marked.agg(
        F.count(F.lit(1)).alias("new_rows"),
        F.count_if(F.col(there).isNull()).cast("bigint").alias("unseen_rows"),
    )
    both = _combine(ex, nw)
    return both.select(
        "existing_rows", "new_rows", "unseen_rows", (F.col("new_rows") - F.col("unseen_rows")).alias("already_seen_rows")
    )


def without_known(df: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Drop rows whose ``key`` is in a list of known duplicates. AQE broadcasts
    the list where its measured bytes allow."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def unseen_by_checksum(
    existing: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    hash_type: str = "md5",
) -> DataFrame:
    """New rows whose row checksum over ``columns`` is not among the existing
    rows' checksums."""
    digest = fresh("__checksum", new)
    seen = existing.select(checksum(columns, hash_type).alias(digest)).distinct()
    tagged = new.withColumn(digest, checksum(columns, hash_type))
    return tagged.join(seen, digest, "left_anti").drop(digest)


def merge_insert_only(target: DataFrame, source: DataFrame, key: str | Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The table after an insert-only merge: ``target`` plus the source rows
    (one per key) whose key is not in the target. Nothing is updated."""
    keys = _keys(key)
    inserts = unseen_rows(target, keep_one(source, keys, order_by=order_by), keys)
    return target.unionByName(inserts)
