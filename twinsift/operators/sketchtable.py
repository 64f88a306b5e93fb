"""Distinct counts kept as a table of sketches: one row a group (a source and a
day, say), with the rows counted, a HyperLogLog sketch and a theta sketch of the
values. What arrives is sketched by itself and merged with what is stored, so
no row is read twice; any union of groups is counted from the table, and theta
sketches also tell how many values two groups share.

A row of the table has a bounded size (``2 ** lg_k`` registers), whatever the
data. NULL values are counted as rows and are in no sketch. The standard error of
a count is about 1.04 / sqrt(2 ** lg_k) of it; that of an overlap is about
1 / sqrt(2 ** lg_k) of the union of the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def rse(lg_k: int = LG_K) -> float:
    """The relative standard error of a count."""
    return 1.04 / 2 ** (lg_k / 2)


def build(df: DataFrame, by: Sequence[str], column: str, lg_k: int = LG_K) -> DataFrame:
    """``by..., rows, hll, theta``: one pass, aggregated on the map side."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(column, lg_k).alias("hll"), F.theta_sketch_agg(column, lg_k).alias("theta"))


def merge(*tables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The tables as one, with one row a group of ``by`` (some or none of their
    group columns: coarser groups are unions of finer ones)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy(*by).agg(F.sum("rows").cast("bigint").alias("rows"), F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta").alias("theta"))


def estimates(table: DataFrame) -> DataFrame:
    """The group columns, ``rows`` and the two estimates of distinct values."""
    rest = [c for c in table.columns if c not in ("rows", "hll", "theta")]
    count = lambda c, f: F.coalesce(f(c), F.lit(0)).cast("bigint")
    return table.select(*rest, "rows", count("hll", F.hll_sketch_estimate).alias("approx_hll"), count("theta", F.theta_sketch_estimate).alias("approx_theta"))


def overlap(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by`` that both tables have (one row without ``by``): how
    many distinct values are in the left, in the right, in both and in the right
    alone, all estimated from the sketches."""
    none = F.lit(None).cast("binary")
    sides = merge(left, by=by).select(*by, F.col("theta").alias("a"), none.alias("b")).unionByName(merge(right, by=by).select(*by, none.alias("a"), F.col("theta").alias("b")))
    both = sides.groupBy(*by).agg(F.first("a", ignorenulls=True).alias("a"), F.first("b", ignorenulls=True).alias("b")).where("a is not null and b is not null")
    n = lambda c: F.theta_sketch_estimate(c).cast("bigint")
    return both.select(
        *by,
        n(F.col("a")).alias("approx_left"),
        n(F.col("b")).alias("approx_right"),
        n(F.theta_intersection("a", "b")).alias("approx_both"),
        n(F.theta_difference("b", "a")).alias("approx_right_only"),
    )
