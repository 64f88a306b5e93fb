"""File-level queries over ``documents`` treated as files (text = content),
plus the per-source report and the object-store inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.operators import files, groups, sketches
from twinsift.operators.survivors import keep_one
from twinsift.plans.jobs import per_source_report, run_file_job
from twinsift.registry import register
from twinsift.session import scratch_path
from twinsift.sources.files import blobs_from_text, write_files
from twinsift.sources.tables import load

_PAD = "lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.txt'"
BLOBS_CTE = (
    "WITH blobs AS (SELECT concat_ws('/', 'doc', source, " + _PAD + ") AS file_path, "
    + _PAD + " AS file_name, CAST(strlen(text) AS BIGINT) AS file_size, md5(text) AS file_hash, doc_id "
    "FROM documents)\n"
)
HASHED = "(SELECT file_path, file_name, file_size, file_hash FROM blobs)"


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs_from_text(load(spark, sf_dir, "documents"), "doc_id", "text", folder="source")


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.hash_files(blobs(spark, sf_dir))


def _last_digit_split(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    existing_ids = F.col("doc_id") % 10 < 7
    h = lambda d: files.hash_files(blobs_from_text(d, "doc_id", "text", folder="source"))
    return h(docs.filter(existing_ids)), h(docs.filter(~existing_ids))


@register("blob_hashes", BLOBS_CTE + f"SELECT * FROM {HASHED}")
def q_blob_hashes(spark, sf_dir):
    return hashed(spark, sf_dir)


_GROUP_SQL = (
    "SELECT file_hash, count(*) AS n, min(file_path) AS first_member, max(file_path) AS last_member, "
    "CAST(sum(file_size) AS BIGINT) AS total_bytes, min(file_size) AS content_bytes "
    "FROM blobs WHERE file_hash IS NOT NULL GROUP BY file_hash HAVING count(*) >= 2"
)


@register("duplicate_groups", BLOBS_CTE + _GROUP_SQL)
def q_duplicate_groups(spark, sf_dir):
    return files.file_groups(hashed(spark, sf_dir))


@register(
    "duplicate_members",
    BLOBS_CTE
    + "SELECT b.file_hash, b.file_path, b.file_name, b.file_size, g.n, b.file_path = g.first_member AS is_survivor "
    "FROM blobs b JOIN (" + _GROUP_SQL + ") g ON b.file_hash = g.file_hash",
)
def q_duplicate_members(spark, sf_dir):
    h = hashed(spark, sf_dir).filter(F.col("file_hash").isNotNull())
    return groups.duplicate_members(h, "file_hash", "file_path")


@register(
    "duplicate_group_sizes",
    BLOBS_CTE + "SELECT *, round(total_bytes / 1024.0, 2) AS total_kb FROM (" + _GROUP_SQL + ")",
)
def q_duplicate_group_sizes(spark, sf_dir):
    g = files.file_groups(hashed(spark, sf_dir))
    return g.withColumn("total_kb", F.round(F.col("total_bytes") / 1024.0, 2))


@register(
    "space_savings",
    BLOBS_CTE
    + "SELECT CAST(sum(n) AS BIGINT) AS total_files, count(*) AS unique_contents, "
    "CAST(sum(n) - count(*) AS BIGINT) AS duplicate_files, CAST(sum(t) AS BIGINT) AS total_bytes, "
    "CAST(sum(b) AS BIGINT) AS unique_bytes, CAST(sum((n - 1) * b) AS BIGINT) AS saved_bytes "
    "FROM (SELECT file_hash, count(*) AS n, min(file_size) AS b, sum(file_size) AS t FROM blobs "
    "WHERE file_hash IS NOT NULL GROUP BY file_hash)",
)
def q_space_savings(spark, sf_dir):
    h = hashed(spark, sf_dir).filter(F.col("file_hash").isNotNull())
    return groups.space_savings(h, "file_hash", "file_size")


@register(
    "groups_by_hash_size",
    BLOBS_CTE
    + "SELECT file_hash, file_size, count(*) AS n, min(file_path) AS first_member, max(file_path) AS last_member "
    "FROM blobs WHERE file_hash IS NOT NULL GROUP BY file_hash, file_size HAVING count(*) >= 2",
)
def q_groups_by_hash_size(spark, sf_dir):
    h = hashed(spark, sf_dir).filter(F.col("file_hash").isNotNull())
    return groups.group_summary(h, ["file_hash", "file_size"], "file_path", min_count=2)


@register(
    "singletons",
    BLOBS_CTE + "SELECT file_hash, min(file_path) AS file_path FROM blobs GROUP BY file_hash HAVING count(*) = 1",
)
def q_singletons(spark, sf_dir):
    return groups.singletons(hashed(spark, sf_dir), "file_hash", "file_path")


@register(
    "one_per_hash",
    BLOBS_CTE
    + "SELECT file_path, file_name, file_size, file_hash FROM (SELECT *, row_number() OVER (PARTITION BY file_hash "
    "ORDER BY file_path, file_name, file_size) AS rn FROM blobs WHERE file_hash IS NOT NULL) WHERE rn = 1 "
    f"UNION ALL SELECT * FROM {HASHED} WHERE file_hash IS NULL",
)
def q_one_per_hash(spark, sf_dir):
    return files.unique_files(hashed(spark, sf_dir))


@register(
    "largest_groups",
    BLOBS_CTE
    + "SELECT file_hash, count(*) AS n, min(file_path) AS first_member, max(file_path) AS last_member "
    "FROM blobs WHERE file_hash IS NOT NULL GROUP BY file_hash HAVING count(*) >= 2 "
    "ORDER BY n DESC, file_hash ASC LIMIT 10",
)
def q_largest_groups(spark, sf_dir):
    h = hashed(spark, sf_dir).filter(F.col("file_hash").isNotNull())
    return groups.largest_groups(h, "file_hash", "file_path", 10)


@register(
    "blob_report",
    BLOBS_CTE
    + "SELECT CAST(sum(n) AS BIGINT) AS total_files, count(*) AS unique_files, "
    "CAST(count_if(n > 1) AS BIGINT) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS duplicate_files, "
    "CAST(sum(t) AS BIGINT) AS total_bytes, CAST(sum((n - 1) * b) AS BIGINT) AS saved_bytes FROM ("
    "SELECT file_hash, count(*) AS n, min(file_size) AS b, sum(file_size) AS t FROM blobs "
    "WHERE file_hash IS NOT NULL GROUP BY file_hash "
    "UNION ALL SELECT NULL, 1, 0, 0 FROM blobs WHERE file_hash IS NULL)",
)
def q_blob_report(spark, sf_dir):
    return files.file_report(hashed(spark, sf_dir))


@register(
    "hll_blobs",
    BLOBS_CTE
    + "SELECT count(DISTINCT file_hash) + CAST(coalesce(max(file_hash IS NULL::INT), 0) AS BIGINT) AS exact_count, "
    "count(DISTINCT file_hash) AS exact_non_null, true AS within_bound FROM blobs",
)
def q_hll_blobs(spark, sf_dir):
    est = files.file_count_estimate(hashed(spark, sf_dir))
    return est.select("exact_count", "exact_non_null", sketches.within_bound("error_pct", sketches.DEFAULT_RSD).alias("within_bound"))


@register(
    "incremental_blobs",
    BLOBS_CTE
    + "SELECT n.file_path, n.file_name, n.file_size, n.file_hash FROM blobs n WHERE n.doc_id % 10 >= 7 "
    "AND NOT EXISTS (SELECT 1 FROM blobs e WHERE e.doc_id % 10 < 7 AND e.file_hash = n.file_hash)",
)
def q_incremental_blobs(spark, sf_dir):
    existing, new = _last_digit_split(spark, sf_dir)
    return files.unseen_files(existing, new)


@register(
    "inventory_by_etag",
    BLOBS_CTE
    + "SELECT key, size, etag FROM (SELECT file_path AS key, file_size AS size, file_hash AS etag, "
    "row_number() OVER (PARTITION BY file_hash ORDER BY file_path ASC NULLS FIRST, file_size ASC NULLS FIRST) AS rn "
    "FROM blobs) WHERE rn = 1",
)
def q_inventory_by_etag(spark, sf_dir):
    """An object-store listing (key, size, etag) deduplicated by ETag."""
    inv = hashed(spark, sf_dir).select(
        F.col("file_path").alias("key"), F.col("file_size").alias("size"), F.col("file_hash").alias("etag")
    )
    return keep_one(inv, ["etag"], order_by=["key"])


@register(
    "per_source_report",
    "SELECT source, CAST(sum(c) AS BIGINT) AS rows, count(*) AS unique_rows, "
    "CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows, "
    "round((sum(c) - count(*)) * 100.0 / sum(c), 4) AS duplicate_rate "
    "FROM (SELECT source, text, count(*) AS c FROM documents GROUP BY source, text) GROUP BY source",
)
def q_per_source_report(spark, sf_dir):
    return per_source_report(load(spark, sf_dir, "documents"), "source", ["text"])


_FILE_SQL = "WITH f AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), h AS (SELECT md5(t) AS file_hash, strlen(t) AS size, count(*) AS n FROM f GROUP BY ALL) "


@register(
    "file_job_report",
    _FILE_SQL
    + "SELECT CAST(sum(n) AS BIGINT) AS total_files, count(*) AS unique_files, CAST(count_if(n > 1) AS BIGINT) AS duplicate_groups, "
    "CAST(sum(n - 1) AS BIGINT) AS duplicate_files, CAST(sum(n * size) AS BIGINT) AS total_bytes, "
    "CAST(sum((n - 1) * size) AS BIGINT) AS saved_bytes FROM h",
)
def q_file_job_report(spark, sf_dir):
    """The file job over real files: each document is written as a file in one
    of sixteen folders; folders are listed and files hashed on the executors."""
    root = scratch_path(spark, "file-job")
    folder = F.concat(F.lit("d"), F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("string"), F.lit("/"))
    write_files(load(spark, sf_dir, "documents"), root, F.concat(folder, F.col("doc_id").cast("string"), F.lit(".txt")), F.encode("text", "UTF-8"))
    return run_file_job(spark, root, glob="*.txt")["report"]
