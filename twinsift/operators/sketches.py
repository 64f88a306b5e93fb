"""Approximate distinct counts (HyperLogLog++) next to the exact count. The
distinct values are found first (reduced before their shuffle); one aggregate
over them makes the sketches and counts, so a sketch is never kept per value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_RSD = 0.05


def _error_cols(approx: str, exact: str, prefix: str = "") -> list:
    err = F.abs(F.col(approx) - F.col(exact))
    pct = F.when(F.col(exact) == 0, F.lit(0.0)).otherwise(err * 100.0 / F.col(exact))
    return [err.cast("bigint").alias(f"{prefix}error"), F.round(pct, 4).alias(f"{prefix}error_pct")]


def approx_distinct(df: DataFrame, column: str, rsd: float = DEFAULT_RSD) -> DataFrame:
    """One row: the HLL++ estimate alone (one pass, fixed-size state)."""
    return df.agg(F.approx_count_distinct(column, rsd).cast("bigint").alias("approx_count"))


def distinct_estimate(df: DataFrame, column: str, rsd: float = DEFAULT_RSD) -> DataFrame:
    """One row: approx_count (HLL; NULL ignored), exact_count (like
    ``select(c).distinct().count()``: NULL counts as one value),
    exact_non_null, and the error of the estimate against exact_non_null
    (error_pct 0 when that is 0), rsd."""
    agg = df.select(column).distinct().agg(
        F.approx_count_distinct(column, rsd).cast("bigint").alias("approx_count"),
        F.count(column).cast("bigint").alias("exact_non_null"),
        F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0)).alias("__has_null"),
    )
    return agg.select(
        "approx_count",
        (F.col("exact_non_null") + F.col("__has_null")).cast("bigint").alias("exact_count"),
        "exact_non_null",
        *_error_cols("approx_count", "exact_non_null"),
        F.lit(rsd).alias("rsd"),
    )


def rsd_sweep(df: DataFrame, column: str, rsds: Sequence[float] = (0.01, 0.05, 0.1)) -> DataFrame:
    """One row per rsd (NULL = Spark's default 0.05): the estimate against
    the exact count, from a single aggregate, unpivoted with ``stack``."""
    aggs = [F.count(column).cast("bigint").alias("exact_count")]
    labels = []
    for i, r in enumerate(rsds):
        aggs.append(F.approx_count_distinct(column, r).cast("bigint").alias(f"a{i}"))
        labels.append((f"{r}", f"a{i}"))
    aggs.append(F.approx_count_distinct(column).cast("bigint").alias("a_default"))
    labels.append(("default", "a_default"))
    wide = df.select(column).distinct().agg(*aggs)
    stack = ", ".join(f"'{lab}', `{c}`" for lab, c in labels)
    long = wide.selectExpr("exact_count", f"stack({len(labels)}, {stack}) AS (rsd, approx_count)")
    return long.select("rsd", "approx_count", "exact_count", *_error_cols("approx_count", "exact_count"))


def hll_rsd(label: str) -> float:
    return DEFAULT_RSD if label == "default" else float(label)


def within_bound(error_pct_col: str, rsd: float, sigmas: float = 3.0):
    """True when the relative error is within ``sigmas`` standard errors."""
    return F.col(error_pct_col) <= sigmas * rsd * 100.0
