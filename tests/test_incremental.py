"""Anti joins, Bloom filter table and sketches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from twinsift.operators import bloom, incremental, sketches
from twinsift.operators.keytable import KeyTable
from twinsift.plans import sizing


def _people(spark, rows):
    return spark.createDataFrame(rows, "id string, email string")


def test_anti_join_keeps_unseen_and_null_keys(spark):
    existing = _people(spark, [("1", "a"), ("2", "b"), ("3", None)])
    new = _people(spark, [("4", "a"), ("5", "c"), ("6", None), ("7", None), ("8", "c")])
    out = sorted(r.id for r in incremental.unseen_rows(existing, new, "email").collect())
    assert out == ["5", "6", "7", "8"]  # NULLs never match; repeats inside new survive


def test_reduced_existing_gives_the_same_rows(spark):
    existing = _people(spark, [(str(i), f"e{i % 50}") for i in range(500)] + [("x", None)])
    new = _people(spark, [("n1", "e3"), ("n2", "zz"), ("n3", None), ("n4", "zz")])
    a = sorted(r.id for r in incremental.unseen_rows(existing, new, "email").collect())
    b = sorted(r.id for r in incremental.unseen_rows(existing, new, "email", reduce_existing=True).collect())
    assert a == b == ["n2", "n3", "n4"]


def test_incremental_report(spark):
    existing = _people(spark, [("1", "a"), ("2", "b")])
    new = _people(spark, [("3", "a"), ("4", "c")])
    r = incremental.incremental_report(existing, new, "email").first()
    assert (r.existing_rows, r.new_rows, r.unseen_rows, r.already_seen_rows) == (2, 2, 1, 1)


def test_without_known_ids(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "id int")
    known = spark.createDataFrame([(1,), (3,), (3,)], "id int")
    assert sorted(r.id for r in incremental.without_known(df, known).collect()) == [0, 2, 4, 5, 6, 7, 8, 9]


def test_null_safe_anti_join_takes_null_for_a_key(spark):
    existing = _people(spark, [("1", "a"), ("3", None)])
    new = _people(spark, [("4", "a"), ("5", "c"), ("6", None)])
    assert [r.id for r in incremental.unseen_rows(existing, new, "email", null_safe=True).collect()] == ["5"]


def test_every_new_row_is_flagged_and_none_dropped(spark):
    existing = _people(spark, [(str(i), f"e{i}") for i in range(200)])
    new = _people(spark, [(f"n{i}", f"e{i}") for i in range(100, 400)] + [("x", None)])
    flags = {r.id: r.maybe_seen for r in bloom.flag_new_rows(existing, new, "email", bloom.BloomSpec(m=600, k=2)).collect()}
    assert len(flags) == 301 and flags["x"] is False
    assert all(flags[f"n{i}"] for i in range(100, 200))  # no false negative, though the filter is crowded


def test_tune_shuffle_from_input_bytes(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert sizing.input_bytes(spark, "/root/testdata/sf0.01/lineitem.parquet") > 0
        n = sizing.tune_shuffle(spark, "/root/testdata/sf0.01/*.parquet", partition_bytes=1024 * 1024)
        assert n >= spark.sparkContext.defaultParallelism and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_merge_insert_only(spark):
    target = _people(spark, [("1", "a")])
    source = _people(spark, [("2", "a"), ("3", "b"), ("4", "b")])
    out = sorted((r.id, r.email) for r in incremental.merge_insert_only(target, source, "email").collect())
    assert out == [("1", "a"), ("3", "b")]


def test_checksum_anti_join(spark):
    cols = "id string, name string, email string"
    existing = spark.createDataFrame([("1", "x", "a")], cols)
    new = spark.createDataFrame([("2", "x", "a"), ("3", "y", "a")], cols)
    out = incremental.unseen_by_checksum(existing, new, ["name", "email"])
    assert [r.id for r in out.collect()] == ["3"]


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    members = spark.range(0, 10000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    spec = bloom.BloomSpec(m=100_000, k=7)
    filt = bloom.build(members, "key", spec)
    probe_keys = spark.range(0, 25000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    flagged = bloom.probe(probe_keys, "key", filt, spec)
    fn = flagged.filter((F.substring("key", 2, 9).cast("int") < 10000) & ~F.col("maybe_seen")).count()
    fp = flagged.filter((F.substring("key", 2, 9).cast("int") >= 10000) & F.col("maybe_seen")).count()
    assert fn == 0
    assert fp < 15000 * 0.02  # theory ~0.8 %


def test_bloom_filters_merge(spark):
    spec = bloom.BloomSpec.for_items(100, 0.01)
    a = spark.createDataFrame([("x",)], "key string")
    b = spark.createDataFrame([("y",)], "key string")
    merged = bloom.merge(bloom.build(a, "key", spec), bloom.build(b, "key", spec))
    probe = spark.createDataFrame([("x",), ("y",), (None,)], "key string")
    out = {r.key: r.maybe_seen for r in bloom.probe(probe, "key", merged, spec).collect()}
    assert out["x"] and out["y"] and out[None] is False


def test_bloom_then_exact_equals_anti_join(spark):
    rng = random.Random(3)
    ex = [(str(i), f"e{rng.randint(0, 400)}") for i in range(300)]
    nw = [(str(1000 + i), f"e{rng.randint(0, 800)}" if i % 10 else None) for i in range(300)]
    existing, new = _people(spark, ex), _people(spark, nw)
    spec = bloom.BloomSpec(m=256, k=2)  # tiny on purpose: many false positives
    got = sorted(tuple(r) for r in bloom.unseen_verified(existing, new, "email", spec).select("id", "email").collect())
    want = sorted(tuple(r) for r in incremental.unseen_rows(existing, new, "email").select("id", "email").collect())
    assert got == want


def test_hll_estimate_and_null_semantics(spark):
    df = spark.createDataFrame([(f"e{i % 22}",) for i in range(200)] + [(None,)], "email string")
    r = sketches.distinct_estimate(df, "email", 0.05).first()
    assert r.exact_count == 23 and r.exact_non_null == 22  # NULL is a value only for the exact count
    assert r.error == abs(r.approx_count - 22) and r.error_pct <= 3 * 0.05 * 100


def test_hll_sweep_rows(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    rows = {r.rsd: r for r in sketches.rsd_sweep(df, "k").collect()}
    assert set(rows) == {"0.01", "0.05", "0.1", "default"}
    assert all(r.exact_count == 1000 and r.error_pct <= 30 for r in rows.values())


def test_split_block_filter_keeps_its_false_positive_rate(spark):
    for fpp in (0.05, 0.01, 0.001):
        spec = bloom.BloomSpec.for_items(20_000, fpp)
        assert bloom.block_fpp(20_000 / spec.blocks) <= fpp * 1.01
        members = spark.range(20_000).select(F.concat(F.lit("in"), "id").alias("key"))
        others = spark.range(60_000).select(F.concat(F.lit("out"), "id").alias("key"))
        filt = bloom.build(members, "key", spec)
        assert filt.count() <= spec.blocks
        assert bloom.maybe_keys(members, "key", filt, spec).count() == 20_000  # none is missed
        wrong = bloom.maybe_keys(others, "key", filt, spec).count() / 60_000
        assert wrong <= fpp + 4 * (fpp / 60_000) ** 0.5, (fpp, wrong)


def test_split_block_filter_makes_one_row_a_key(spark):
    """Neither building nor probing multiplies rows, and both are aggregated on the map side."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spec = bloom.BloomSpec.for_items(1000)
        keys = spark.range(1000).select(F.col("id").cast("string").alias("key"))
        plan = bloom.maybe_keys(keys, "key", bloom.build(keys, "key", spec), spec)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Generate" not in plan and "partial_bit_or" in plan and "SortAggregate" not in plan


def test_split_block_filters_merge_and_replay(spark):
    spec = bloom.BloomSpec.for_items(3000)
    part = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("key"))
    rows = lambda f: sorted(tuple(r) for r in f.select("block", *bloom.LONGS).collect())
    whole = rows(bloom.build(part(0, 3000), "key", spec))
    one, two = bloom.build(part(0, 2000), "key", spec), bloom.build(part(1500, 3000), "key", spec)
    assert rows(bloom.merge(one, two)) == whole == rows(bloom.merge(one, two, two, one))
    found = bloom.unseen_verified(part(0, 2000), part(1500, 3000), "key", spec, one)  # with a stored filter
    assert found.count() == 1000


def test_unseen_rows_with_clashing_names_and_nulls(spark):
    ex = spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), ("a", 3, "z")], "__seen0 string, __batch0 int, __c string")
    new = spark.createDataFrame([("a", 5, "q"), (None, 6, "r"), ("b", 7, "s"), ("b", 7, "s")], "__seen0 string, __batch0 int, __c string")
    for reduce in (False, True):
        plain = incremental.unseen_rows(ex, new, "__seen0", reduce_existing=reduce)
        assert sorted(map(str, plain.select("__batch0").collect())) == ["Row(__batch0=6)", "Row(__batch0=7)", "Row(__batch0=7)"]
        safe = incremental.unseen_rows(ex, new, "__seen0", reduce_existing=reduce, null_safe=True)
        assert [r[0] for r in safe.select("__batch0").collect()] == [7, 7] and safe.columns == new.columns
    assert tuple(incremental.incremental_report(ex, new, "__seen0").first()) == (3, 4, 3, 1)
    assert incremental.unseen_by_checksum(ex, new.withColumn("__checksum", F.lit(1)), ["__seen0"]).count() == 2


def test_key_table_is_not_moved(spark):
    """The plan of a batch has no exchange on the table's side, however many files the buckets have."""
    rows = lambda a, b: spark.range(a, b).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 7).cast("int").alias("g"), F.col("id").alias("v"))
    table = KeyTable.create(rows(0, 5000), ["k", "g"], buckets=8)
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(c, v)
        for step in range(3):
            plan = table.unseen(rows(4000, 7000))._jdf.queryExecution().executedPlan().toString()
            scan = next(x for x in plan.splitlines() if "FileScan" in x)
            assert "Bucketed: true" in scan and table.table in scan
            above = plan[plan.index("LeftSemi") : plan.index(scan)].split("FileScan")[0].splitlines()
            depth = scan.index("FileScan")
            # walk up from the scan to the join: filter, project, sort, but no exchange
            path = []
            for line in reversed(above):
                here = len(line) - len(line.lstrip(" :+-*"))
                if here < depth:
                    depth = here
                    path.append(line)
            assert path and not any("Exchange" in line for line in path), (step, path)
            if step == 0:
                assert table.unseen(rows(4000, 7000)).count() == 2000
                table.add(rows(4000, 6000))
                table.add(rows(4000, 6000))  # again: nothing new
                assert table.read().count() == 6000 and table.unseen(rows(4000, 7000)).count() == 1000
            elif step == 1:
                table.compact()
                assert table.read().count() == 6000 and table.unseen(rows(4000, 7000)).count() == 1000
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_key_table_and_nulls(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, g int")
    table = KeyTable.create(rows, ["k", "g"], buckets=2)
    assert table.read().count() == 1
    new = spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), ("b", None, "z"), ("c", 3, "w"), ("c", 3, "w")], "k string, g int, __seen0 string")
    got = table.unseen(new)
    assert sorted(r["__seen0"] for r in got.collect()) == ["w", "w", "y", "z"] and got.columns == new.columns
    empty = KeyTable.create(rows.limit(0), ["k"], buckets=2)
    assert empty.unseen(new.select("k")).count() == 5
