"""File-level deduplication by content hash: hashes, duplicate groups, one
file per content, savings, approximate counts and new-against-existing.

Files are hashed in chunks on the executors, whatever their size
(``hash_listed``); content that is a column already is hashed by
``hash_files``. Both give the same digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.operators import groups, sketches
from twinsift.operators.survivors import keep_one

HASH_TYPES = ("md5", "sha256")
HASHED_COLUMNS = ("file_path", "file_name", "file_size", "file_hash")


def content_hash(content: str = "content", hash_type: str = "md5"):
    if hash_type == "md5":
        return F.md5(F.col(content))
    if hash_type == "sha256":
        return F.sha2(F.col(content), 256)
    raise ValueError(f"hash_type must be one of {HASH_TYPES}, got {hash_type!r}")


def hash_files(files: DataFrame, hash_type: str = "md5") -> DataFrame:
    """``file_path, file_name, file_size, file_hash``; unreadable content
    (NULL) gives a NULL hash and is never a duplicate of anything."""
    return files.select("file_path", "file_name", "file_size", content_hash("content", hash_type).alias("file_hash"))


def hash_listed(listing: DataFrame, hash_type: str = "md5", chunk_bytes: int = 8 << 20) -> DataFrame:
    """``file_path, file_name, file_size, file_hash, error`` of listed files
    of ANY size: each is hashed in chunks on an executor. A file that can't be
    read has a NULL hash and the reason in ``error``."""
    from twinsift.functions.digest import digest_batches

    if hash_type not in HASH_TYPES:
        raise ValueError(f"hash_type must be one of {HASH_TYPES}, got {hash_type!r}")
    schema = "file_path string, file_name string, file_size bigint, file_hash string, error string"
    return listing.select("file_path", "file_name", "file_size").mapInPandas(digest_batches(hash_type, chunk_bytes), schema)


def hash_files_chunked(
    spark,
    path: str,
    hash_type: str = "md5",
    glob: str | None = None,
    recursive: bool = False,
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    """Like ``hash_files(scan_files(...))`` without a file in one cell: the
    listing reads no content."""
    from twinsift.sources.files import list_files

    return hash_listed(list_files(spark, path, glob, recursive), hash_type, chunk_bytes).drop("error")


def hash_paths(spark, paths, hash_type: str = "md5", chunk_bytes: int = 8 << 20) -> DataFrame:
    """``hash_listed`` of the files among ``paths`` that exist; tasks ask the
    file systems, not the driver."""
    from twinsift.functions.digest import stat_batches

    rows = spark.createDataFrame([(str(p),) for p in paths], "file_path string").distinct()
    found = rows.mapInPandas(stat_batches(), "file_path string, file_name string, file_size bigint")
    return hash_listed(found, hash_type, chunk_bytes)


def unique_files(hashed: DataFrame) -> DataFrame:
    """One file per content, the first path in path order; files with a NULL
    hash (unreadable) are each kept. One pass over ``hashed``."""
    content_key = F.coalesce(F.col("file_hash"), F.concat(F.lit("\u0000"), F.col("file_path")))
    return keep_one(hashed, [content_key], order_by=["file_path"])


def file_groups(hashed: DataFrame) -> DataFrame:
    """Duplicate groups: ``file_hash, n, first_member, last_member,
    total_bytes, content_bytes``."""
    return groups.duplicate_groups(hashed.filter(F.col("file_hash").isNotNull()), "file_hash", "file_path", "file_size")


def file_report(hashed: DataFrame) -> DataFrame:
    """One row: total_files, unique_files, duplicate_groups, duplicate_files,
    total_bytes, saved_bytes (bytes freed by keeping one file per content).
    Unreadable files (NULL hash) count as unique files without bytes. One
    pass: a per-content aggregate, then a one-row aggregate."""
    per = hashed.groupBy("file_hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("file_size").alias("b"), F.sum("file_size").alias("t")
    )
    known = F.col("file_hash").isNotNull()
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_files"),
        (F.count_if(known) + F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0))).cast("bigint").alias("unique_files"),
        F.count_if(known & (F.col("n") > 1)).cast("bigint").alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("duplicate_files"),
        F.coalesce(F.sum(F.when(known, F.col("t"))), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.coalesce(F.sum(F.when(known, (F.col("n") - 1) * F.col("b"))), F.lit(0)).cast("bigint").alias("saved_bytes"),
    )


def file_count_estimate(hashed: DataFrame, rsd: float = sketches.DEFAULT_RSD) -> DataFrame:
    """Approximate number of distinct contents against the exact number."""
    return sketches.distinct_estimate(hashed, "file_hash", rsd)


def unseen_files(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New hashed files whose content is not among the existing ones (repeats
    among the new files survive; NULL hashes are kept)."""
    seen = existing.select("file_hash").filter(F.col("file_hash").isNotNull()).distinct()
    return new.join(seen, "file_hash", "left_anti").select(*HASHED_COLUMNS)
