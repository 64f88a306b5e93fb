"""End-to-end jobs: read, deduplicate, report, write.

The deduplicated result is written ONCE and the report is computed from the
written table, so the plan does not run again for every action and the
reported survivors are the written ones.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from twinsift.operators import files as file_ops
from twinsift.operators.reports import dedup_report
from twinsift.plans.methods import DEFAULT_KEYS, HASH_KEYS, dedup
from twinsift.plans.sizing import tune_shuffle
from twinsift.session import cut_lineage
from twinsift.sources.files import list_files, list_paths
from twinsift.sources.sinks import write_parquet
from twinsift.sources.tables import read_sources, read_table

RECORD_OUTPUT = "deduplicated_{base}.parquet"
FILE_OUTPUT = "file_deduplication_results.parquet"


def output_path(input_path: str, output_dir: str, template: str = RECORD_OUTPUT) -> str:
    base = os.path.splitext(os.path.basename(input_path.rstrip("/")))[0]
    return f"{output_dir.rstrip('/')}/{template.format(base=base)}"


def run_job(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    method: str = "exact",
    schema: StructType | str | None = None,
    validate_keys: Sequence[str] = DEFAULT_KEYS,
    tune: bool = False,
    **opts,
) -> tuple[str, DataFrame]:
    """Read ``input_path``, deduplicate by ``method``, write Parquet to
    ``output_dir/deduplicated_<base>.parquet``; return (path, report).
    ``tune`` sizes the shuffle partitions from the input's bytes first."""
    if tune:
        tune_shuffle(spark, input_path)
    df = read_table(spark, input_path, schema=schema)
    out = output_path(input_path, output_dir)
    write_parquet(dedup(df, method, **opts), out)
    return out, dedup_report(df, spark.read.parquet(out), list(validate_keys))


def per_source_report(df: DataFrame, source: str, keys: Sequence[str]) -> DataFrame:
    """Per source: rows, unique_rows (distinct keys within the source),
    duplicate_rows, duplicate_rate (%). Two aggregates; the first reduces
    each (source, key) map-side, so a hot source or key is cheap."""
    per_key = df.groupBy(source, *keys).agg(F.count(F.lit(1)).alias("c"))
    total = F.sum("c")
    unique = F.count(F.lit(1))
    return per_key.groupBy(source).agg(
        total.cast("bigint").alias("rows"),
        unique.alias("unique_rows"),
        (total - unique).cast("bigint").alias("duplicate_rows"),
        F.round((total - unique) * 100.0 / total, 4).alias("duplicate_rate"),
    )


def run_sources_job(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    keys: Sequence[str] = DEFAULT_KEYS,
    fmt: str = "csv",
    output_dir: str | None = None,
    method: str = "exact",
    skip_prefix: str | None = "deduplicated_",
    **opts,
) -> DataFrame:
    """Many input files in ONE job: each file is deduplicated in itself by
    ``method``, and with ``output_dir`` the survivors are written there,
    partitioned by ``source_file``. Returns the report: one row per file and
    one, ``(all)``, for their total.

    Files named ``skip_prefix...`` (outputs of earlier runs) are reported as
    ``skipped`` (None takes them too); a file that can't be read is reported
    as ``no rows read`` and doesn't end the job; malformed CSV rows are
    counted in ``corrupt_rows``."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    fields = st.fieldNames()
    options = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
    if fmt == "csv" and "_corrupt_record" not in fields:
        st = st.add("_corrupt_record", "string")
        options["columnNameOfCorruptRecord"] = "_corrupt_record"
    read = read_sources(spark, paths, st, fmt=fmt, skip_prefix=None, **options)
    listed = list_paths(spark, paths).select(F.col("file_path").alias("__file"))
    base = F.element_at(F.split("__file", "/"), -1)
    skipped = base.startswith(skip_prefix) if skip_prefix else F.lit(False)
    if skip_prefix:
        read = read.filter(~F.element_at(F.split("source_file", "/"), -1).startswith(skip_prefix))
    bad = F.col("_corrupt_record").isNotNull() if fmt == "csv" else F.lit(False)
    # the parsed rows are written once; counts and survivors read the copy
    rows = cut_lineage(read.select(*[c for c in fields if c != "_corrupt_record"], "source_file", bad.alias("__bad"), F.md5("source_file").alias("__source")))
    good = rows.filter(~F.col("__bad")).drop("__bad")
    hash_columns = [c for c in opts.pop("hash_columns", HASH_KEYS) if c in good.columns]
    unique = dedup(good, method, keys=["__source", *keys], hash_columns=["__source", *hash_columns], **opts).drop("__source")
    if output_dir:
        unique.write.mode("overwrite").partitionBy("source_file").parquet(output_dir)
        unique = spark.read.schema(unique.schema).parquet(output_dir)
    counts = rows.groupBy("source_file").agg(F.count_if(~F.col("__bad")).alias("rows"), F.count_if("__bad").alias("corrupt_rows"))
    kept = unique.groupBy("source_file").agg(F.count(F.lit(1)).alias("unique_rows"))
    zero = F.lit(0).cast("bigint")
    per = (
        listed.join(counts.withColumn("__file", _plain("source_file")).drop("source_file"), "__file", "left")
        .join(kept.withColumn("__file", _plain("source_file")).drop("source_file"), "__file", "left")
        .select(
            F.col("__file").alias("source_file"),
            *[F.coalesce(c, zero).alias(c) for c in ("rows", "unique_rows", "corrupt_rows")],
            F.when(skipped, "skipped").when(F.col("rows").isNull(), "no rows read").otherwise("done").alias("status"),
        )
    )
    total = per.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("rows", "unique_rows", "corrupt_rows")]).select(F.lit("(all)").alias("source_file"), "*", F.lit("done").alias("status"))
    lost = F.col("rows") - F.col("unique_rows")
    return per.unionByName(total).select(
        "source_file", "rows", "unique_rows", lost.alias("duplicate_rows"),
        F.round(F.when(F.col("rows") > 0, lost * 100.0 / F.col("rows")), 4).alias("duplicate_rate"), "corrupt_rows", "status",
    )


def _plain(column: str) -> F.Column:
    """A file's path, decoded and with one slash after ``file:``."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(column, r"\+", "%2B")), r"^file:/+", "file:/")


def run_file_job(
    spark: SparkSession,
    path: str,
    output_dir: str | None = None,
    hash_type: str = "md5",
    glob: str | None = None,
    recursive: bool = True,
    chunk_bytes: int = 8 << 20,
) -> dict[str, DataFrame]:
    """List, hash (in chunks, whatever the size) and group files on the
    executors; with ``output_dir`` the unique files are written to
    ``file_deduplication_results.parquet``. ``unreadable`` holds the files that
    can't be read, with the reason."""
    # the small hashed table (no content) is written once: file bytes are read once
    tried = cut_lineage(file_ops.hash_listed(list_files(spark, path, glob=glob, recursive=recursive), hash_type, chunk_bytes))
    hashed = tried.drop("error")
    unique = file_ops.unique_files(hashed)
    if output_dir:
        out = f"{output_dir.rstrip('/')}/{FILE_OUTPUT}"
        write_parquet(unique, out)
        unique = spark.read.parquet(out)
    return {
        "hashed": hashed,
        "unreadable": tried.filter(F.col("file_hash").isNull()).select("file_path", "error"),
        "unique": unique,
        "groups": file_ops.file_groups(hashed),
        "report": file_ops.file_report(hashed),
    }
