"""Incremental deduplication queries: anti joins, Bloom filter, merges,
splits. Existing / new are the two parts of one whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.functions.keys import digest_bucket
from twinsift.operators import bloom, exact, incremental
from twinsift.operators.keytable import KeyTable
from twinsift.registry import register
from twinsift.registry.records import people
from twinsift.registry.sqltext import PEOPLE_COLUMNS, keep_one_sql, with_people
from twinsift.session import scratch_path
from twinsift.sources import sinks
from twinsift.sources.tables import load

EXISTING_DIGITS = ("0", "1", "2", "3", "4", "5", "6")
_IN = "(" + ", ".join(f"'{d}'" for d in EXISTING_DIGITS) + ")"
SPLIT_CTES = (
    f", existing AS (SELECT * FROM people WHERE right(id, 1) IN {_IN})"
    f", new AS (SELECT * FROM people WHERE right(id, 1) NOT IN {_IN})"
)
ANTI_SQL = "SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.email = n.email)"


def people_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Existing = people whose id ends in 0-6, new = the rest: a stable
    stand-in for a random 70/30 split; together the whole table."""
    p = people(spark, sf_dir)
    last = F.substring("id", -1, 1)
    return p.filter(last.isin(*EXISTING_DIGITS)), p.filter(~last.isin(*EXISTING_DIGITS))


def _spec(existing: DataFrame, key: str, fpp: float = 0.01) -> bloom.BloomSpec:
    """Size the filter from an HLL estimate of the existing distinct keys."""
    n = existing.agg(F.approx_count_distinct(key)).first()[0]
    return bloom.BloomSpec.for_items(max(n, 1) * 1.2, fpp)


@register("incremental_anti_join", with_people(ANTI_SQL, SPLIT_CTES))
def q_incremental_anti_join(spark, sf_dir):
    existing, new = people_split(spark, sf_dir)
    return incremental.unseen_rows(existing, new, "email")


@register(
    "incremental_report",
    with_people(
        "SELECT (SELECT count(*) FROM existing) AS existing_rows, (SELECT count(*) FROM new) AS new_rows, "
        f"(SELECT count(*) FROM ({ANTI_SQL})) AS unseen_rows, "
        f"(SELECT count(*) FROM new) - (SELECT count(*) FROM ({ANTI_SQL})) AS already_seen_rows",
        SPLIT_CTES,
    ),
)
def q_incremental_report(spark, sf_dir):
    existing, new = people_split(spark, sf_dir)
    return incremental.incremental_report(existing, new, "email")


_EARLY = "CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 10 < 5"


@register(
    "incremental_bucketed",
    with_people(
        "SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.email = n.email) "
        f"AND ({_EARLY} OR NOT EXISTS (SELECT 1 FROM new b WHERE {_EARLY.replace('id', 'b.id')} AND b.email = n.email))",
        SPLIT_CTES,
    ),
)
def q_incremental_bucketed(spark, sf_dir):
    """Two batches against a bucketed table of the existing keys, which learns
    the first one's: the rows of each batch whose key was not there."""
    existing, new = people_split(spark, sf_dir)
    table = KeyTable.create(existing, ["email"], buckets=16)
    early = digest_bucket("id", 10) < 5
    first, second = new.filter(early), new.filter(~early)
    path = scratch_path(spark, "bucketed-first")
    table.unseen(first).write.parquet(path)  # before the table learns them
    table.add(first)
    return spark.read.parquet(path).unionByName(table.unseen(second))


@register(
    "known_duplicates_anti",
    "SELECT d.* FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def q_known_duplicates_anti(spark, sf_dir):
    return incremental.without_known(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "doc_id")


_CK = "md5(concat_ws('|', coalesce({p}name, ''), coalesce({p}email, ''), coalesce({p}address, '')))"


@register(
    "incremental_checksum",
    with_people(
        "SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE "
        + _CK.format(p="e.") + " = " + _CK.format(p="n.") + ")",
        SPLIT_CTES,
    ),
)
def q_incremental_checksum(spark, sf_dir):
    existing, new = people_split(spark, sf_dir)
    return incremental.unseen_by_checksum(existing, new, ["name", "email", "address"])


@register(
    "merge_insert_only",
    with_people(
        "SELECT * FROM existing UNION ALL SELECT s.* FROM ("
        + keep_one_sql("new", PEOPLE_COLUMNS, ["email"])
        + ") s WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.email = s.email)",
        SPLIT_CTES,
    ),
)
def q_merge_insert_only(spark, sf_dir):
    existing, new = people_split(spark, sf_dir)
    return incremental.merge_insert_only(existing, new, "email")


@register(
    "bloom_new_rows",
    with_people(
        "SELECT n.*, EXISTS (SELECT 1 FROM existing e WHERE e.email = n.email) AS seen, false AS missed FROM new n",
        SPLIT_CTES,
    ),
)
def q_bloom_new_rows(spark, sf_dir):
    """All new rows with the filter's flag held against the truth: ``missed``
    (seen, but not flagged) is never true, a false positive is no error."""
    existing, new = people_split(spark, sf_dir)
    flagged = bloom.flag_new_rows(existing, new, "email", _spec(existing, "email"))
    truth = existing.select("email").distinct().withColumn("__in", F.lit(True))
    seen = F.coalesce(F.col("__in"), F.lit(False))
    both = flagged.join(truth, "email", "left").withColumn("seen", seen)
    return both.select(*PEOPLE_COLUMNS, "seen", (F.col("seen") & ~F.col("maybe_seen")).alias("missed"))


@register("bloom_then_exact", with_people(ANTI_SQL, SPLIT_CTES))
def q_bloom_then_exact(spark, sf_dir):
    """The filter is that of the new keys, at most 2/5 of the people (30 % of
    the ids and some copies); a count of customers comes from the file's footer."""
    existing, new = people_split(spark, sf_dir)
    customers = load(spark, sf_dir, "customer").count()
    return bloom.unseen_verified(existing, new, "email", bloom.BloomSpec.for_items(max(1, customers * 2 // 5)))


@register(
    "bloom_membership",
    with_people("SELECT DISTINCT email, true AS maybe_seen FROM existing WHERE email IS NOT NULL", SPLIT_CTES),
)
def q_bloom_membership(spark, sf_dir):
    """Every existing key probed against the filter built from them: all are
    reported as members (a Bloom filter has no false negatives)."""
    existing, _ = people_split(spark, sf_dir)
    spec = _spec(existing, "email")
    members = existing.select("email").filter(F.col("email").isNotNull()).distinct()
    return bloom.probe(members, "email", bloom.build(existing, "email", spec), spec)


@register(
    "hash_split",
    with_people(
        "SELECT *, CASE WHEN CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 10 < 7 THEN 'existing' ELSE 'new' END AS part FROM people"
    ),
)
def q_hash_split(spark, sf_dir):
    """Checkable 70/30 split: bucket of the id's md5, stable across runs,
    partitionings and engines (unlike ``randomSplit``)."""
    p = people(spark, sf_dir)
    return p.withColumn("part", F.when(digest_bucket("id", 10) < 7, F.lit("existing")).otherwise(F.lit("new")))


@register(
    "append_unseen",
    with_people(
        "SELECT * FROM existing UNION ALL SELECT n.* FROM new n WHERE NOT EXISTS "
        "(SELECT 1 FROM existing e WHERE e.email IS NOT DISTINCT FROM n.email)",
        SPLIT_CTES,
    ),
)
def q_append_unseen(spark, sf_dir):
    """A written table of the existing people that takes in the new ones, twice:
    the second time adds nothing (NULL is a key like any other)."""
    existing, new = people_split(spark, sf_dir)
    target = scratch_path(spark, "append")
    sinks.write_parquet(existing, target)
    for _ in range(2):
        sinks.append_unseen(spark, new, target, "email")
    return spark.read.parquet(target)


@register("rewrite_in_place", with_people(keep_one_sql("people", PEOPLE_COLUMNS, ["email"])))
def q_rewrite_in_place(spark, sf_dir):
    """A written table of the people that is replaced by its own deduplication."""
    path = scratch_path(spark, "rewrite")
    sinks.write_parquet(people(spark, sf_dir), path)
    sinks.rewrite_deduplicated(spark, path, lambda df: exact.exact_dedup(df, ["email"]))
    return spark.read.parquet(path)
