"""Physical plan shapes: exchanges, group limits, pruning, join strategies."""

from __future__ import annotations

import pytest

from tests.conftest import SF0001
from twinsift.operators import bloom, exact, incremental, survivors
from twinsift.registry import queries
from twinsift.sources.tables import load

STREAMING = {"stream_dedup", "stream_seen_table", "stream_bloom_seen_table", "stream_file_arrivals", "stream_keyed_state"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_partitioned_dedup_reduces_before_it_deals_out(no_aqe):
    li = load(no_aqe, SF0001, "lineitem")
    plan = _plan(exact.partitioned_dedup(li, ["l_orderkey", "l_linenumber"], 16))
    # rows are cut to one a key on the map side, before anything is dealt out
    assert plan.count("WindowGroupLimit") == 2 and ", 16)" in plan


def test_keep_one_limits_groups_before_the_shuffle(no_aqe):
    li = load(no_aqe, SF0001, "lineitem")
    plan = _plan(survivors.keep_one(li, ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"]))
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) and final


def test_repeats_never_window_whole_groups(no_aqe):
    plan = _plan(survivors.repeats(load(no_aqe, SF0001, "lineitem"), ["l_orderkey"]))
    # the only window is keep_one's, cut by a group limit on both sides
    assert plan.count("WindowGroupLimit") == 2


def test_distinct_rows_aggregates_map_side(no_aqe):
    plan = _plan(exact.distinct_rows(load(no_aqe, SF0001, "lineitem")))
    first_agg, exchange = plan.rfind("HashAggregate"), plan.find("Exchange")
    assert plan.count("HashAggregate") == 2 and exchange < first_agg  # partial aggregate below the exchange


def test_anti_join_reads_only_key_columns(no_aqe):
    ex = load(no_aqe, SF0001, "orders")
    new = load(no_aqe, SF0001, "orders")
    plan = _plan(incremental.unseen_rows(ex.select("o_orderkey", "o_custkey"), new, "o_custkey"))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert any("ReadSchema: struct<o_custkey:bigint>" in s for s in scans)


def test_filter_is_pushed_to_the_scan(no_aqe):
    df = exact.drop_null_keys(load(no_aqe, SF0001, "customer"), ["c_name"])
    assert "PushedFilters: [IsNotNull(c_name)]" in _plan(df)


def test_small_bloom_filter_is_broadcast(no_aqe):
    keys = load(no_aqe, SF0001, "orders").select("o_custkey")
    spec = bloom.BloomSpec.for_items(1000, 0.01)
    plan = _plan(bloom.probe(keys, "o_custkey", bloom.build(keys, "o_custkey", spec), spec))
    assert "BroadcastHashJoin" in plan
    no_aqe.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_big = _plan(bloom.probe(keys, "o_custkey", bloom.build(keys, "o_custkey", spec), spec))
    finally:
        no_aqe.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan_big


@pytest.mark.parametrize("name", sorted(n for n in queries() if n not in STREAMING))
def test_no_cross_product_in_registered_queries(spark, name):
    plan = _plan(queries()[name](spark, SF0001))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
