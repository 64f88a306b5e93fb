"""Deduplication by method name, and the method comparison table.

Method names and their key columns follow the published contract: the pair
methods (``fuzzy_levenshtein``, ``fuzzy_fuzzywuzzy``, ``lsh``) only REPORT
similar pairs; their deduplicated output is exact deduplication on the keys
(``resolve=True`` merges clusters of similar records instead).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.operators import exact
from twinsift.operators.survivors import keep_one

DEFAULT_KEYS = ("name", "email")
HASH_KEYS = ("name", "email", "address")

METHODS = (
    "exact",
    "window",
    "normalized",
    "fuzzy_levenshtein",
    "fuzzy_fuzzywuzzy",
    "lsh",
    "checksum_md5",
    "checksum_sha256",
    "spark_hash",
    "partitioned_hash",
)


def dedup(
    df: DataFrame,
    method: str = "exact",
    keys: Sequence[str] = DEFAULT_KEYS,
    hash_columns: Sequence[str] = HASH_KEYS,
    order_by: Sequence[str] = ("id",),
    num_partitions: int = 100,
    resolve: bool = False,
    id_col: str = "id",
    **fuzzy_opts,
) -> DataFrame:
    """Deduplicated rows by ``method``; unknown names raise ``ValueError``."""
    keys = list(keys)
    order = [c for c in order_by if c in df.columns]
    if method == "exact":
        return exact.exact_dedup(df, keys)
    if method == "window":
        return keep_one(df, keys, order_by=order)
    if method == "normalized":
        return exact.normalized_dedup(df, keys)
    if method in ("fuzzy_levenshtein", "fuzzy_fuzzywuzzy", "lsh"):
        if resolve:
            from twinsift.operators.clusters import resolve_entities

            return resolve_entities(df, method, keys, id_col=id_col, **fuzzy_opts)
        return exact.exact_dedup(df, keys)
    if method == "checksum_md5":
        return exact.fingerprint_dedup(df, hash_columns, "md5")
    if method == "checksum_sha256":
        return exact.fingerprint_dedup(df, hash_columns, "sha256")
    if method == "spark_hash":
        return exact.fingerprint_dedup(df, hash_columns, "concat_md5")
    if method == "partitioned_hash":
        return exact.partitioned_dedup(df, keys, num_partitions)
    raise ValueError(f"unknown method {method!r}; expected one of {METHODS}")


PAIR_METHODS = ("fuzzy_levenshtein", "fuzzy_fuzzywuzzy", "lsh")


def similar_values(df: DataFrame, method: str, columns: Sequence[str] = DEFAULT_KEYS, threshold: float | None = None) -> DataFrame:
    """What a pair method finds, by VALUE and not by row: ``column_name,
    value, representative, n_rows`` for every value that is similar to others
    of its column (a chain counts), with the smallest value of its group and
    the rows that hold it. Its size follows the values, never the row pairs."""
    from twinsift.operators.clusters import value_groups

    parts = None
    for c in columns:
        part = value_groups(df, c, method, threshold)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def compare_methods(df: DataFrame, methods: Sequence[str] = METHODS, **opts) -> DataFrame:
    """One row per method: method, original_count, unique_count,
    duplicates_removed, dedup_rate (%). All methods are counted in one job:
    each contributes a tagged count, and the tagged counts are unioned."""
    parts = None
    for m in methods:
        part = dedup(df, m, **opts).agg(F.count(F.lit(1)).alias("unique_count")).select(
            F.lit(m).alias("method"), "unique_count"
        )
        parts = part if parts is None else parts.unionByName(part)
    # the input's row count as a scalar subquery: computed once, no join
    total = df.agg(F.count(F.lit(1))).scalar()
    removed = F.col("original_count") - F.col("unique_count")
    return parts.withColumn("original_count", total).select(
        "method",
        "original_count",
        "unique_count",
        removed.alias("duplicates_removed"),
        F.round(F.when(F.col("original_count") > 0, removed * 100.0 / F.col("original_count")), 4).alias("dedup_rate"),
    )
