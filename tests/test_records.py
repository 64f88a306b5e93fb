"""Record-level operators on the six-row fixture and NULL cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import ids
from twinsift.functions import keys
from twinsift.operators import exact, groups, reports, survivors
from twinsift.plans.methods import METHODS, compare_methods, dedup


def test_exact_all_columns_keeps_six(sample):
    assert exact.exact_dedup(sample).count() == 6


def test_exact_on_name_email(sample):
    out = exact.exact_dedup(sample, ["name", "email"])
    assert out.count() == 5
    assert out.groupBy("name", "email").count().filter("count > 1").count() == 0


def test_no_duplicates_input_unchanged(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, name string, email string")
    assert exact.exact_dedup(df, ["name", "email"]).count() == 2


def test_keep_first_and_last(sample):
    first = survivors.keep_one(sample, ["name", "email"], order_by=["id"], keep="first")
    last = survivors.keep_one(sample, ["name", "email"], order_by=["id"], keep="last")
    assert ids(first) == ["ID1", "ID3", "ID4", "ID5", "ID6"]
    assert ids(last) == ["ID2", "ID3", "ID4", "ID5", "ID6"]


def test_keep_other_than_last_means_first(sample):
    out = survivors.keep_one(sample, ["name", "email"], order_by=["id"], keep="anything")
    assert ids(out) == ["ID1", "ID3", "ID4", "ID5", "ID6"]


def test_normalized_dedup_three(sample):
    out = exact.normalized_dedup(sample, ["name", "email"])
    assert out.count() == 3
    assert out.columns == sample.columns
    assert ids(out) == ["ID1", "ID3", "ID6"]
    assert out.filter(F.col("id") == "ID1").first().name == "Tarik Oduya"  # original value kept


def test_normalize_columns_added_and_lowercase(sample):
    out = keys.normalize_columns(sample)
    assert {"name_normalized", "email_normalized", "address_normalized"} <= set(out.columns)
    row = out.filter(F.col("id") == "ID4").first()
    assert row.name_normalized == "tarik oduya" and row.email_normalized == "tarik@lindenpost.org"
    assert out.filter(F.col("id") == "ID5").first().name_normalized == "tarik oduya"


def test_normalize_nulls_become_empty(spark):
    df = spark.createDataFrame([("1", None, "  "), ("2", "", None)], "id string, name string, email string")
    out = keys.normalize_columns(df, ["name", "email"]).collect()
    assert all(r.name_normalized == "" and r.email_normalized == "" for r in out)
    kept = {r.id: r.name_normalized for r in keys.normalize_columns(df, ["name"], steps=("lower", "trim")).collect()}
    assert kept == {"1": None, "2": ""}


def test_normalize_trim_keeps_tabs(spark):
    df = spark.createDataFrame([("\tA ",)], "v string")
    assert df.select(keys.normalized("v")).first()[0] == "\ta"


def test_checksum_three_columns_five(sample):
    assert exact.fingerprint_dedup(sample, ["name", "email", "address"], "md5").count() == 5
    assert exact.fingerprint_dedup(sample, ["name", "email", "address"], "sha256").count() == 5


def test_checksum_null_equals_empty_but_concat_skips(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], "x string, y string, z string")
    md5 = [r[0] for r in df.select(keys.checksum(["x", "y", "z"])).collect()]
    assert md5[0] == md5[2] and md5[0] != md5[1]
    cat = [r[0] for r in df.select(keys.concat_hash(["x", "y", "z"])).collect()]
    assert cat[0] == cat[1]


def test_json_fingerprint_is_delimiter_safe(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    pipe = {r[0] for r in df.select(keys.checksum(["x", "y"])).collect()}
    js = {r[0] for r in df.select(keys.json_fingerprint(["x", "y"])).collect()}
    assert len(pipe) == 1 and len(js) == 2


def test_hash64_dedup_never_merges_different_rows(sample):
    assert exact.fingerprint_dedup(sample, ["name", "email", "address"], "xxhash64").count() == 5


def test_unknown_hash_type_raises(sample):
    with pytest.raises(ValueError):
        keys.checksum(["name"], "crc32")


def test_bucket_of_is_never_negative(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    assert df.select(keys.bucket_of(["k"], 7).alias("b")).agg(F.min("b"), F.max("b")).first() == (0, 6)


def test_partitioned_dedup_equals_exact(sample):
    a = exact.partitioned_dedup(sample, ["name", "email"], 3)
    b = exact.exact_dedup(sample, ["name", "email"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_map_key_rejected(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    with pytest.raises(TypeError):
        survivors.keep_one(df, ["m"])


def test_array_key_allowed(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1), ([1.0, 2.0], 2), ([3.0], 3)], "e array<double>, i int")
    assert exact.exact_dedup(df, ["e"]).count() == 2


def test_repeats_and_survivors_partition_input(sample):
    keep = survivors.keep_one(sample, ["email"])
    rest = survivors.repeats(sample, ["email"])
    assert sorted(keep.union(rest).collect()) == sorted(sample.collect())


def test_repeats_with_exact_copies_and_nulls(spark):
    rows = [("k", None, 1), ("k", None, 1), ("k", None, 1), ("k", "b", 2), ("j", None, 3), ("j", None, 3)]
    df = spark.createDataFrame(rows, "key string, v string, n int")
    got = sorted((tuple(r) for r in survivors.repeats(df, ["key"]).collect()), key=str)
    # survivors (first in total order): ('j', None, 3) and ('k', None, 1)
    assert got == sorted([("k", None, 1), ("k", None, 1), ("k", "b", 2), ("j", None, 3)], key=str)


def test_partitioned_dedup_equals_exact_dedup(spark):
    rows = [("hot", i % 7, f"v{i}") for i in range(500)] + [("cold", 1, "x")]
    df = spark.createDataFrame(rows, "k string, a int, b string")
    got = exact.partitioned_dedup(df, ["k"], 4)
    assert got.rdd.getNumPartitions() == 4 and sorted(got.collect()) == sorted(exact.exact_dedup(df, ["k"]).collect())
    with_map = df.withColumn("m", F.create_map("k", "b"))
    assert exact.partitioned_dedup(with_map, ["k"], 4).count() == 2


def test_repeats_of_a_hot_row_go_to_many_tasks(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it merges what is small here
    try:
        sizes = [n for n in survivors.repeats(df, ["k"]).rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 179_999 and max(sizes) < 0.6 * sum(sizes)


def test_latest_wins(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "k int, v string, ts int")
    new = spark.createDataFrame([(1, "a2", 20), (2, "b0", 5)], "k int, v string, ts int")
    out = {r.k: r.v for r in survivors.latest_wins(old, new, ["k"], "ts").collect()}
    assert out == {1: "a2", 2: "b"}


def test_keep_most_complete(spark):
    df = spark.createDataFrame(
        [("1", "x", None, "short"), ("2", "x", "e", None), ("3", "x", "e", "a longer one")],
        "id string, name string, email string, address string",
    )
    assert ids(survivors.keep_most_complete(df, ["name"])) == ["3"]


def test_merge_records_first_non_null(spark):
    df = spark.createDataFrame(
        [("k", 1, None, "b1"), ("k", 2, "a2", None), ("k", 3, "a3", "b3")], "key string, t int, a string, b string"
    )
    r = survivors.merge_records(df, ["key"], "t").first()
    assert (r.t, r.a, r.b) == (1, "a2", "b1")


def test_validation_report(sample):
    out = exact.exact_dedup(sample, ["name", "email"])
    r = reports.dedup_report(sample, out, ["name", "email"]).first()
    assert (r.original_count, r.deduplicated_count, r.duplicates_removed) == (6, 5, 1)
    assert r.dedup_rate == pytest.approx(16.6667, abs=1e-3)
    assert r.remaining_duplicate_groups == 0


def test_validation_report_empty_input_rate_null(spark):
    empty = spark.createDataFrame([], "name string, email string")
    r = reports.dedup_report(empty, empty, ["name", "email"]).first()
    assert r.original_count == 0 and r.dedup_rate is None


def test_duplicate_keys_and_overview(sample):
    assert groups.duplicate_keys(sample, ["name", "email"]).count() == 1
    r = reports.duplicate_overview(sample, ["name", "email"]).first()
    assert (r.total_rows, r.unique_keys, r.duplicate_rows) == (6, 5, 1)


def test_sampled_overview_is_within_the_sample(spark):
    df = spark.range(10000).select((F.col("id") % 100).alias("k"))
    r = reports.sampled_overview(df, ["k"], 0.1, 7).first()
    # a key comes with all its rows
    assert 2 <= r.unique_keys <= 25 and r.total_rows == 100 * r.unique_keys and r.duplicate_rate == 99.0


def test_distinct_counts_count_null_as_value(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert reports.distinct_counts(df, ["c"]).first().distinct_count == 2


def test_method_dispatch_all_methods(sample):
    counts = {r.method: r.unique_count for r in compare_methods(sample).collect()}
    assert set(counts) == set(METHODS)
    assert counts["exact"] == 5 and counts["normalized"] == 3 and counts["checksum_md5"] == 5
    assert counts["fuzzy_levenshtein"] == counts["exact"]


def test_unknown_method_raises(sample):
    with pytest.raises(ValueError):
        dedup(sample, "nope")


def test_fuzzy_resolve_merges_similar_records(sample):
    out = dedup(sample, "fuzzy_levenshtein", resolve=True)
    assert ids(out) == ["ID1", "ID3", "ID6"]


def test_late_dedup_equals_exact(spark):
    from twinsift.operators import exact

    rows = [(1, "a", 0.0, [1.0]), (2, "a", -0.0, [1.0]), (3, None, None, None), (4, None, None, None), (5, "b", float("nan"), []), (6, "b", float("nan"), []), (7, "c", 1.0, [2.0]), (7, "c", 1.0, [2.0])]
    df = spark.createDataFrame(rows, "id int, k string, __hash double, v array<double>")
    for keys in (["k"], ["k", "__hash"], ["v"], None):
        got = exact.late_dedup(df, keys, order_by=["id"] if keys else ())
        want = exact.exact_dedup(df, keys, order_by=["id"] if keys else ())
        assert got.columns == df.columns
        plain = lambda x: sorted(str(r).replace("-0.0", "0.0") for r in x.collect())  # noqa: E731 (a distinct turns -0.0 into 0.0)
        assert plain(got) == plain(want), keys
    assert exact.late_dedup(df.limit(0), ["k"]).count() == 0


_SHUFFLE_SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from twinsift.operators import exact
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.eventLog.compress", "false").getOrCreate())
df = spark.read.parquet(sys.argv[2])
out = getattr(exact, sys.argv[3])(df, ["key"], order_by=["id"])
print(out.agg(F.count("*"), F.sum(F.xxhash64(*out.columns).cast("decimal(38,0)"))).first())
spark.stop()
"""


def test_late_dedup_shuffles_few_bytes(spark, tmp_path):
    """Wide rows of which few repeat: bytes shuffled, by the event log."""
    import json
    import os
    import subprocess
    import sys

    wide = spark.range(20_000).select(F.col("id"), (F.col("id") % 19_000).alias("key"), F.concat_ws("", *[F.md5(F.concat(F.lit(str(k)), "id").cast("string")) for k in range(12)]).alias("wide"))
    wide.write.parquet(f"{tmp_path}/t")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said, written = {}, {}
    for name in ("exact_dedup", "late_dedup"):
        folder = f"{tmp_path}/{name}"
        os.makedirs(folder)
        out = subprocess.run([sys.executable, "-c", _SHUFFLE_SCRIPT.format(repo=repo), folder, f"{tmp_path}/t", name], capture_output=True, text=True, timeout=300)
        assert out.returncode == 0, out.stderr[-2000:]
        said[name], written[name] = out.stdout.strip(), 0
        for path in [os.path.join(d, x) for d, _, names in os.walk(folder) for x in names if not x.startswith((".", "appstatus"))]:
            with open(path) as log:
                for e in map(json.loads, log):
                    if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                        written[name] += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    assert said["exact_dedup"] == said["late_dedup"]
    assert written["late_dedup"] < 0.3 * written["exact_dedup"], written


def test_interval_of_the_duplicate_rate_covers_it(spark):
    """Over 100 seeds, the 95 % interval holds the table's rate about as often."""
    df = spark.range(4000).select((F.col("id") % 1500 * (F.col("id") % 7 + 1) % 1300).alias("k"), F.col("id").alias("v"))
    df = df.unionByName(df.where("k % 11 = 3")).cache()
    true = reports.duplicate_overview(df, ["k"]).first()["duplicate_rate"]
    held, rows = 0, None
    for seed in range(100):
        one = reports.duplicate_rate_interval(df, ["k"], 0.3, seed)
        rows = one if rows is None else rows.unionByName(one)
    got = rows.collect()
    held = sum(r["low"] <= true <= r["high"] for r in got)
    assert len(got) == 100 and 88 <= held <= 100, held
    whole = reports.duplicate_rate_interval(df, ["k"], 1.0).first()
    assert whole["duplicate_rate"] == true == whole["low"] == whole["high"] and whole["standard_error"] == 0
    none = reports.duplicate_rate_interval(df.limit(0), ["k"]).first()
    assert none["sampled_rows"] == 0 and none["duplicate_rate"] is None and none["low"] is None
    df.unpersist()


def test_both_orientations(spark):
    from twinsift.operators import fuzzy

    pairs = spark.createDataFrame([("a", "b", 1), ("a", "c", 2)], "value_a string, value_b string, distance int")
    got = sorted(tuple(r) for r in fuzzy.both_orientations(pairs).collect())
    assert got == [("a", "b", 1), ("a", "c", 2), ("b", "a", 1), ("c", "a", 2)]


def test_sketch_tables_merge(spark):
    from twinsift.operators import sketchtable as st

    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 4).alias("day"), F.concat(F.lit("u"), F.col("id") % 9_000).alias("u"))
    df = df.unionByName(spark.createDataFrame([(0, 0, None), (9, 0, None)], "g long, day long, u string"))
    parts = [st.build(df.where(F.col("g") % 2 == k), ["g", "day"], "u") for k in (0, 1)]
    whole = {r["g"]: r for r in st.estimates(st.merge(*parts, by=["g"])).collect()}
    again = {r["g"]: r for r in st.estimates(st.merge(st.merge(*parts, by=["g", "day"]), by=["g"])).collect()}
    assert whole == again  # merging in steps is the same
    assert whole[9]["rows"] == 1 and whole[9]["approx_hll"] == whole[9]["approx_theta"] == 0
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("u").alias("n")).collect()}
    for g in (0, 1, 2):
        for c in ("approx_hll", "approx_theta"):
            assert abs(whole[g][c] - exact[g]) <= 3 * st.rse() * exact[g] + 1
    a, b = df.where("g < 2"), df.where("g >= 1")
    told = st.overlap(st.build(a, [], "u"), st.build(b, [], "u")).first()
    both = a.select("u").distinct().join(b.select("u").distinct(), "u").count()
    assert abs(told["approx_both"] - both) <= 3 * st.rse() * 9_000
    per = st.overlap(st.build(a, ["day"], "u"), st.build(b, ["day"], "u"), by=["day"])
    assert per.count() == 4
