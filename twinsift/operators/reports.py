"""Reports as one-row (or one-row-per-item) DataFrames: validation,
duplicate overview, data quality, distinct counts.

Two single-row aggregates are combined by a union and a final aggregate,
never by a join, so each input is scanned once and no cross product appears.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rate(removed: Column, total: Column) -> Column:
    """Percentage, NULL on empty input, rounded to 4 places."""
    return F.round(F.when(total > 0, removed.cast("double") * 100.0 / total.cast("double")), 4)


def _combine(*parts: DataFrame) -> DataFrame:
    """Merge one-row frames with disjoint columns into one row."""
    cols = [c for p in parts for c in p.columns]
    filled = []
    for p in parts:
        filled.append(p.select(*[F.col(c) if c in p.columns else F.lit(None).cast(_type(parts, c)).alias(c) for c in cols]))
    out = filled[0]
    for p in filled[1:]:
        out = out.unionByName(p)
    return out.agg(*[F.max(c).alias(c) for c in cols])


def _type(parts: Sequence[DataFrame], col: str):
    for p in parts:
        if col in p.columns:
            return p.schema[col].dataType
    raise KeyError(col)


def dedup_report(original: DataFrame, deduplicated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """original_count, deduplicated_count, duplicates_removed, dedup_rate (%),
    remaining_duplicate_groups (keys still repeated in the output)."""
    o = original.agg(F.count(F.lit(1)).alias("original_count"))
    d = (
        deduplicated.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(
            F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("deduplicated_count"),
            F.count_if(F.col("c") > 1).cast("bigint").alias("remaining_duplicate_groups"),
        )
    )
    both = _combine(o, d)
    removed = F.col("original_count") - F.col("deduplicated_count")
    return both.select(
        "original_count",
        "deduplicated_count",
        removed.alias("duplicates_removed"),
        _rate(removed, F.col("original_count")).alias("dedup_rate"),
        "remaining_duplicate_groups",
    )


def duplicate_overview(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """total_rows, unique_keys, duplicate_rows (rows beyond the first of
    their key), duplicate_rate (%)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    total = F.coalesce(F.sum("c"), F.lit(0)).cast("bigint")
    unique = F.count(F.lit(1))
    return per_key.agg(
        total.alias("total_rows"),
        unique.alias("unique_keys"),
        (total - unique).alias("duplicate_rows"),
        _rate(total - unique, total).alias("duplicate_rate"),
    )


def _sampled(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    whole = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    bucket = F.conv(F.substring(F.md5(whole), 1, 8), 16, 10).cast("bigint") % 10_000
    return df.filter(bucket < round(fraction * 10_000))


def duplicate_rate_interval(df: DataFrame, keys: Sequence[str], fraction: float = 0.1, seed: int = 42, sigmas: float = 1.96) -> DataFrame:
    """How sure the quick look is: the duplicate rate (%) of the sampled keys
    with its standard error and the interval ``low`` to ``high`` of ``sigmas``
    standard errors on either side (95 % for 1.96).

    A sampled key has all its rows, so keys are clusters and the rate is a
    ratio: duplicates over rows. With e = (n - 1) - rate * n for a key of n
    rows, the variance of the ratio is (1 - fraction) * sum(e^2) / rows^2.
    ``expected_duplicates`` is what the whole table should have. One aggregate
    over the sampled keys; NULL on an empty sample."""
    per_key = _sampled(df, keys, fraction, seed).groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = per_key.agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("x"), F.sum(F.col("n") * F.col("n")).alias("xx"))
    x, m = F.col("x"), F.col("m")
    rate = (x - m) / x
    # e = n * (1 - rate) - 1, so its squares add up from the sums
    squares = F.greatest(F.lit(0.0), F.col("xx") * (1 - rate) * (1 - rate) - 2 * (1 - rate) * x + m)
    error = F.sqrt(F.lit(1.0 - fraction) * squares) / x
    percent = lambda c: F.round(F.when(x > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) * 100), 4)
    return sums.select(
        m.alias("sampled_keys"),
        F.coalesce(x, F.lit(0.0)).cast("bigint").alias("sampled_rows"),
        percent(rate).alias("duplicate_rate"),
        percent(error).alias("standard_error"),
        percent(rate - sigmas * error).alias("low"),
        percent(rate + sigmas * error).alias("high"),
        F.round((x - m) / F.lit(float(fraction))).cast("bigint").alias("expected_duplicates"),
    )


def sampled_overview(df: DataFrame, keys: Sequence[str], fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """``duplicate_overview`` of a sample of KEYS (a quick look before a full
    run): all rows of a sampled key are in it, so the rate estimates the
    table's. The sample follows from the keys' md5 and ``seed``; any engine can
    draw the same."""
    return duplicate_overview(_sampled(df, keys, fraction, seed), keys)


def key_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: NULL values and blank (empty after trim) values."""
    aggs = []
    for c in columns:
        aggs += [
            F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}__null"),
            F.count_if(F.trim(F.col(c)) == "").cast("bigint").alias(f"{c}__blank"),
        ]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    stack = ", ".join(f"'{c}', `{c}__null`, `{c}__blank`" for c in columns)
    return wide.selectExpr("rows", f"stack({len(columns)}, {stack}) AS (column_name, null_count, blank_count)")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the number of distinct values, NULL counted as a value
    (like ``select(c).distinct().count()``), all in one aggregate."""
    aggs = []
    for c in columns:
        aggs.append(
            (F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).cast("bigint").alias(c)
        )
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, distinct_count)")
