"""Drop-in functions under the published method names and signatures, so
existing calls keep working. Each one delegates to the Spark-first
operators; statistics come back as dicts as before (one small row read
on the driver), DataFrames stay lazy.

Differences, on purpose: survivors are deterministic; pair functions return
pairs of distinct values (see the README); unknown methods and hash types
raise ``ValueError``; files are hashed on the executors.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.functions.digest import file_digest
from twinsift.functions.keys import normalize_columns
from twinsift.operators import bloom, exact, fuzzy, incremental, minhash, reports, sketches
from twinsift.operators import files as file_ops
from twinsift.operators.survivors import keep_one
from twinsift.plans.jobs import FILE_OUTPUT, run_job
from twinsift.session import cut_lineage
from twinsift.sources.sinks import write_parquet
from twinsift.sources.tables import read_table


# ---- records --------------------------------------------------------------


def exact_deduplication(df: DataFrame, key_columns: Sequence[str] | None = None) -> DataFrame:
    return exact.exact_dedup(df, key_columns)


def window_based_deduplication(df: DataFrame, key_columns, order_by: str = "id", keep: str = "first") -> DataFrame:
    return keep_one(df, list(key_columns), order_by=[order_by], keep=keep)


def normalize_data(df: DataFrame) -> DataFrame:
    return normalize_columns(df, ("name", "email", "address"))


def fuzzy_deduplication_levenshtein(df: DataFrame, threshold: int = 2) -> DataFrame:
    """Normalised name and email values within ``threshold`` edits, per column."""
    from twinsift.functions.keys import normalized

    return fuzzy.column_edit_pairs(df, ["name", "email"], threshold, key=normalized)


def fuzzy_deduplication_fuzzywuzzy(df: DataFrame, threshold: int = 85) -> DataFrame:
    """Distinct names with similarity ratio >= ``threshold``."""
    return fuzzy.ratio_pairs(df.select("name"), threshold)


def lsh_deduplication(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Token sets of ``name`` closer than ``threshold`` (Jaccard distance) by
    MinHash LSH with 1024 hashed features and 5 tables, tokenised as MLlib's
    ``Tokenizer`` does (single-blank splits; empty tokens count)."""
    sets = minhash.token_sets(df.filter(F.col("name").isNotNull()), "name", pattern=r"\s", keep_empty=True)
    return minhash.mllib_lsh_pairs(sets, threshold, num_features=1024, verify=False)


def checksum_based_deduplication(df: DataFrame, columns: Sequence[str] | None = None, hash_type: str = "md5") -> DataFrame:
    if hash_type not in ("md5", "sha256"):
        raise ValueError(f"hash_type must be 'md5' or 'sha256', got {hash_type!r}")
    return exact.fingerprint_dedup(df, columns, hash_type)


def spark_hash_deduplication(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return exact.fingerprint_dedup(df, columns, "concat_md5")


def partitioned_hash_deduplication(df: DataFrame, key_columns, num_partitions: int = 100) -> DataFrame:
    return exact.partitioned_dedup(df, list(key_columns), num_partitions)


def validate_deduplication(original_df: DataFrame, deduplicated_df: DataFrame, key_columns) -> dict:
    r = reports.dedup_report(original_df, deduplicated_df, list(key_columns)).first()
    return {
        "original_count": r.original_count,
        "unique_count": r.deduplicated_count,
        "duplicates_removed": r.duplicates_removed,
        "deduplication_rate": r.dedup_rate,
        "remaining_duplicate_groups": r.remaining_duplicate_groups,
    }


def process_file_spark(spark: SparkSession, input_path: str, output_dir: str | None = None, method: str = "exact") -> dict:
    """Read, deduplicate by ``method``, write ``deduplicated_<base>.parquet``
    next to the input (or into ``output_dir``), return the validation."""
    out_dir = output_dir or os.path.dirname(input_path.rstrip("/")) or "."
    _, report = run_job(spark, input_path, out_dir, method)
    r = report.first()
    return {
        "original_count": r.original_count,
        "unique_count": r.deduplicated_count,
        "duplicates_removed": r.duplicates_removed,
        "deduplication_rate": r.dedup_rate,
    }


# ---- sketches and incremental ---------------------------------------------


def bloom_filter_deduplication_exact(
    spark: SparkSession, existing_df: DataFrame, new_df: DataFrame, key_column: str = "email", error_rate: float = 0.01
) -> DataFrame:
    """New rows the Bloom filter of the existing keys does not contain: those
    it is sure of, as published (``bloom.flag_new_rows`` keeps the others too)."""
    n = existing_df.agg(F.approx_count_distinct(key_column)).first()[0]
    return bloom.surely_new(existing_df, new_df, key_column, bloom.BloomSpec.for_items(max(n, 1) * 1.2, error_rate))


def bloom_filter_deduplication_spark(
    spark: SparkSession,
    existing_df: DataFrame,
    new_df: DataFrame,
    key_column: str = "email",
    expected_items: int | None = None,
    fpp: float = 0.01,
) -> DataFrame:
    """New rows whose key is not among the existing keys (exact anti join)."""
    return incremental.unseen_rows(existing_df, new_df, key_column)


def hyperloglog_distinct_count(df: DataFrame, column: str = "email", rsd: float = 0.05) -> dict:
    r = sketches.distinct_estimate(df, column, rsd).first()
    return {
        "approx_distinct": r.approx_count,
        "exact_distinct": r.exact_count,
        "error": r.error,
        "error_percent": r.error_pct,
        "rsd": r.rsd,
    }


def compare_methods(spark: SparkSession, df: DataFrame, key_column: str = "email") -> DataFrame:
    """Exact count against HLL at rsd 0.01, 0.05, 0.1 and the default."""
    return sketches.rsd_sweep(df, key_column)


def incremental_deduplication_example(spark: SparkSession, existing_path: str, new_path: str, key_column: str = "email") -> DataFrame:
    return incremental.unseen_rows(read_table(spark, existing_path), read_table(spark, new_path), key_column)


# ---- files ----------------------------------------------------------------


def _hashed_files(spark: SparkSession, file_paths: Sequence[str], hash_type: str = "md5") -> DataFrame | None:
    hashed = cut_lineage(file_ops.hash_paths(spark, file_paths, hash_type).drop("error"))
    return None if hashed.isEmpty() else hashed


def compute_file_hash(file_path: str, hash_type: str = "md5") -> str | None:
    """Hex digest of one file read on the caller's machine; None when the file
    cannot be read. For many files use the Spark functions below."""
    return file_digest(file_path, hash_type)[0]


def file_level_deduplication(spark: SparkSession, file_paths: Sequence[str], output_dir: str = "data"):
    """(unique files, duplicate groups); (None, None) when no path exists."""
    hashed = _hashed_files(spark, file_paths)
    if hashed is None:
        return None, None
    return file_ops.unique_files(hashed), file_ops.file_groups(hashed)


def exact_file_deduplication(spark: SparkSession, file_paths: Sequence[str], hash_type: str = "md5", output_dir: str | None = None):
    hashed = _hashed_files(spark, file_paths, hash_type)
    if hashed is None:
        return None, None
    unique = file_ops.unique_files(hashed)
    if output_dir:
        out = f"{output_dir.rstrip('/')}/{FILE_OUTPUT}"
        write_parquet(unique, out)
        unique = spark.read.parquet(out)
    return unique, file_ops.file_groups(hashed)


def deduplicate_files(spark: SparkSession, file_paths: Sequence[str], output_dir: str | None = None):
    return exact_file_deduplication(spark, file_paths, "md5", output_dir)


def hyperloglog_file_count(spark: SparkSession, file_paths: Sequence[str], hash_type: str = "md5") -> dict:
    hashed = _hashed_files(spark, file_paths, hash_type)
    if hashed is None:
        return {"total_files": 0, "approx_unique": 0, "exact_unique": 0, "duplicates": 0, "error": 0, "error_percent": 0.0}
    r = hashed.agg(
        F.count(F.lit(1)).alias("total"),
        F.approx_count_distinct("file_hash", sketches.DEFAULT_RSD).alias("approx"),
        F.count_distinct("file_hash").alias("exact"),
    ).first()
    error = abs(r.approx - r.exact)
    return {
        "total_files": r.total,
        "approx_unique": r.approx,
        "exact_unique": r.exact,
        "duplicates": r.total - r.exact,
        "error": error,
        "error_percent": round(error * 100.0 / r.exact, 4) if r.exact else 0.0,
    }


def bloom_filter_file_deduplication(spark: SparkSession, existing_files, new_files, hash_type: str = "md5") -> DataFrame | None:
    """New files whose content is not among the existing files."""
    new = _hashed_files(spark, new_files, hash_type)
    if new is None:
        return None
    existing = _hashed_files(spark, existing_files, hash_type)
    if existing is None:
        return new
    return file_ops.unseen_files(existing, new)


def compare_file_deduplication_methods(spark: SparkSession, file_paths: Sequence[str]) -> dict:
    unique, groups = exact_file_deduplication(spark, file_paths)
    return {
        "exact_unique": unique.count() if unique is not None else 0,
        "duplicate_groups": groups.count() if groups is not None else 0,
        "hyperloglog": hyperloglog_file_count(spark, file_paths),
    }
