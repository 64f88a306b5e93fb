"""Duplicate groups: which keys repeat, group summaries, members, sizes and
space savings.

A group is summarised by aggregates only (count, sums, min/max member), which
run with map-side partial aggregation; a group that holds a third of all rows
is never gathered into one array or one task. Members are listed as rows, by
joining the summaries back (AQE splits a hot key on the member side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """Keys that occur at least ``min_count`` times, with their ``count``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_count)


def group_summary(
    df: DataFrame,
    key: str | Sequence[str],
    member: str,
    size: str | None = None,
    min_count: int = 1,
) -> DataFrame:
    """One row per group: ``n`` members, ``first_member``/``last_member`` in
    member order, and with ``size`` the group's ``total_bytes`` and the
    ``content_bytes`` of one member."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.min(member).alias("first_member"),
        F.max(member).alias("last_member"),
    ]
    if size is not None:
        aggs += [F.sum(size).alias("total_bytes"), F.min(size).alias("content_bytes")]
    out = df.groupBy(*keys).agg(*aggs)
    return out.filter(F.col("n") >= min_count) if min_count > 1 else out


def duplicate_groups(df: DataFrame, key: str, member: str, size: str | None = None) -> DataFrame:
    """Groups with more than one member."""
    return group_summary(df, key, member, size, min_count=2)


def duplicate_members(df: DataFrame, key: str, member: str) -> DataFrame:
    """Every member of a duplicate group as a row, with the group's size and
    whether the member is the group's survivor (first member)."""
    groups = duplicate_groups(df, key, member).select(key, "n", "first_member")
    return (
        df.join(groups, key, "inner")
        .withColumn("is_survivor", F.col(member) == F.col("first_member"))
        .drop("first_member")
    )


def singletons(df: DataFrame, key: str, member: str) -> DataFrame:
    """Contents that occur exactly once, with their only member."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), F.min(member).alias(member))
        .filter(F.col("n") == 1)
        .select(key, member)
    )


def space_savings(df: DataFrame, key: str, size: str) -> DataFrame:
    """One row: files, distinct contents, duplicate files, total bytes, bytes
    after keeping one copy per content, and the bytes saved
    (``sum(size * (n - 1))`` over groups)."""
    per_group = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("b"), F.sum(size).alias("t"))
    return per_group.agg(
        F.sum("n").cast("bigint").alias("total_files"),
        F.count(F.lit(1)).alias("unique_contents"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_files"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("unique_bytes"),
        F.coalesce(F.sum((F.col("n") - 1) * F.col("b")), F.lit(0)).cast("bigint").alias("saved_bytes"),
    )


def largest_groups(df: DataFrame, key: str, member: str, k: int = 10) -> DataFrame:
    """Top-``k`` duplicate groups by member count (ties by key): the limit is
    the feature, planned as ``TakeOrderedAndProject``."""
    return duplicate_groups(df, key, member).orderBy(F.col("n").desc(), F.col(key).asc()).limit(k)
