"""Empty, all-duplicate and Unicode inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from twinsift.functions import keys
from twinsift.functions.similarity import edit_distance
from twinsift.operators import bloom, clusters, exact, files, fuzzy, groups, incremental, minhash, reports, sketches, survivors
from twinsift.plans.methods import METHODS, dedup

PEOPLE = "id string, name string, email string, address string"


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], PEOPLE)


@pytest.mark.parametrize("method", [m for m in METHODS])
def test_every_method_on_empty_input(empty, method):
    assert dedup(empty, method).count() == 0


def test_operators_on_empty_input(spark, empty):
    assert survivors.keep_one(empty, ["email"]).count() == 0
    assert survivors.repeats(empty, ["email"]).count() == 0
    assert exact.partitioned_dedup(empty, ["email"], 4).count() == 0
    assert incremental.unseen_rows(empty, empty, "email").count() == 0
    assert groups.duplicate_keys(empty, ["email"]).count() == 0
    r = reports.duplicate_overview(empty, ["email"]).first()
    assert r.total_rows == 0 and r.duplicate_rate is None
    assert sketches.distinct_estimate(empty, "email").first().exact_count == 0
    spec = bloom.BloomSpec.for_items(10)
    assert bloom.unseen_verified(empty, empty, "email", spec).count() == 0
    assert fuzzy.edit_pairs(empty.select("name"), 2).count() == 0
    assert clusters.entity_clusters(empty).count() == 0
    assert minhash.jaccard_pairs(minhash.token_sets(empty, "name"), 0.7).count() == 0
    hashed = spark.createDataFrame([], "file_path string, file_name string, file_size long, file_hash string")
    rep = files.file_report(hashed).first()
    assert rep.total_files == 0 and rep.saved_bytes == 0


def test_all_duplicates_collapse_to_one(spark):
    df = spark.createDataFrame([("1", "A", "a@x", "s")] * 50, PEOPLE)
    assert exact.exact_dedup(df).count() == 1
    assert survivors.repeats(df, ["id", "name", "email", "address"]).count() == 49
    assert exact.partitioned_dedup(df, ["email"], 8).count() == 1
    r = reports.dedup_report(df, exact.exact_dedup(df, ["email"]), ["email"]).first()
    assert (r.duplicates_removed, r.dedup_rate) == (49, 98.0)


def test_unicode_edit_distance_counts_code_points(spark):
    df = spark.createDataFrame([("é", "e"), ("Zoë", "Zoe"), ("日本", "日本語")], "a string, b string")
    assert [r[0] for r in df.select(edit_distance("a", "b")).collect()] == [1, 1, 1]


def test_unicode_normalisation(spark):
    df = spark.createDataFrame([("  ÉCOLE ",), ("école",)], "v string")
    assert {r[0] for r in df.select(keys.normalized("v")).collect()} == {"école"}


def test_unicode_pairs_are_found(spark):
    df = spark.createDataFrame([("müller",), ("muller",), ("møller",), ("smith",)], "v string")
    got = {(r.value_a, r.value_b) for r in fuzzy.edit_pairs(df, 1).collect()}
    assert got == {("muller", "müller"), ("muller", "møller"), ("møller", "müller")}


def test_null_keys_group_together_in_exact_dedup(spark):
    df = spark.createDataFrame([("1", None, None, "x"), ("2", None, None, "y"), ("3", "n", None, "z")], PEOPLE)
    assert exact.exact_dedup(df, ["name", "email"]).count() == 2


def test_hash_split_is_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    a = df.select(keys.bucket_of(["id"], 10).alias("b")).collect()
    b = df.repartition(7).select("id", keys.bucket_of(["id"], 10).alias("b")).orderBy(F.col("id").cast("int")).collect()
    assert [r.b for r in a] == [r.b for r in b]
