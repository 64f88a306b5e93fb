"""Approximate distinct count queries. The HLL estimate itself differs
between engines, so the oracle checks the exact counts and that the
estimate is within three standard errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsift.operators import sketches, sketchtable
from twinsift.operators.reports import _combine as combine
from twinsift.registry import register
from twinsift.registry.records import events_split
from twinsift.session import scratch_path
from twinsift.sources.tables import load

RSD = 0.05


@register(
    "hll_distinct",
    "SELECT count(DISTINCT o_custkey) + CAST(coalesce(max(o_custkey IS NULL::INT), 0) AS BIGINT) AS exact_count, "
    "count(DISTINCT o_custkey) AS exact_non_null, true AS within_bound FROM orders",
)
def q_hll_distinct(spark, sf_dir):
    est = sketches.distinct_estimate(load(spark, sf_dir, "orders"), "o_custkey", RSD)
    return est.select("exact_count", "exact_non_null", sketches.within_bound("error_pct", RSD).alias("within_bound"))


@register(
    "hll_sweep",
    "SELECT r AS rsd, (SELECT count(DISTINCT o_custkey) FROM orders) AS exact_count, true AS within_bound "
    "FROM (VALUES ('0.01'), ('0.05'), ('0.1'), ('default')) t(r)",
)
def q_hll_sweep(spark, sf_dir):
    sweep = sketches.rsd_sweep(load(spark, sf_dir, "orders"), "o_custkey")
    bound = F.col("error_pct") <= F.when(F.col("rsd") == "default", RSD).otherwise(F.col("rsd").cast("double")) * 300.0
    return sweep.select("rsd", "exact_count", bound.alias("within_bound"))


@register(
    "sketch_table",
    "SELECT event_type, count(*) AS rows, count(DISTINCT user_id) AS exact_count, true AS hll_within_bound, "
    "true AS theta_within_bound FROM events GROUP BY event_type",
)
def q_sketch_table(spark, sf_dir):
    """Users by event type from a stored table of daily sketches that took in
    the events in two parts, beside the exact count."""
    path = scratch_path(spark, "sketches")
    for part in events_split(spark, sf_dir):
        sketchtable.build(part.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id").write.mode("append").parquet(path)
    told = sketchtable.estimates(sketchtable.merge(spark.read.parquet(path), by=["event_type"]))
    exact = load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("type")).agg(F.count_distinct("user_id").alias("exact_count"))
    near = lambda c: F.abs(F.col(c) - F.col("exact_count")) <= 3 * sketchtable.rse() * F.col("exact_count") + 1
    both = told.join(exact, F.col("event_type").eqNullSafe(F.col("type")))
    return both.select("event_type", "rows", "exact_count", near("approx_hll").alias("hll_within_bound"), near("approx_theta").alias("theta_within_bound"))


@register(
    "sketch_overlap",
    "WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_id % 10 < 7), "
    "b AS (SELECT DISTINCT user_id FROM events WHERE event_id % 10 >= 7) "
    "SELECT (SELECT count(user_id) FROM a) AS existing, (SELECT count(user_id) FROM b) AS new, "
    "(SELECT count(*) FROM a JOIN b ON a.user_id = b.user_id) AS exact_both, true AS within_bound",
)
def q_sketch_overlap(spark, sf_dir):
    """Users of the existing events and of the new ones, and those in both:
    estimated from two sketches, beside the exact counts."""
    existing, new = events_split(spark, sf_dir)
    told = sketchtable.overlap(sketchtable.build(existing, [], "user_id"), sketchtable.build(new, [], "user_id"))
    users = existing.select("user_id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(new.select("user_id", F.lit(0).alias("a"), F.lit(1).alias("b")))
    per = users.where("user_id is not null").groupBy("user_id").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    exact = per.agg(F.count_if(F.col("a") == 1).alias("existing"), F.count_if(F.col("b") == 1).alias("new"), F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("exact_both"), F.count("*").alias("either"))
    both = combine(told, exact)
    off = 3 * sketchtable.rse() * F.col("either") + 1
    near = (F.abs(F.col("approx_both") - F.col("exact_both")) <= off) & (F.abs(F.col("approx_left") - F.col("existing")) <= off) & (F.abs(F.col("approx_right") - F.col("new")) <= off)
    return both.select("existing", "new", "exact_both", near.alias("within_bound"))
