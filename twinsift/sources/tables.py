"""Record sources: Parquet and CSV scans, in-memory fixtures, and multi-file
reads tagged with their source file."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def join_path(base: str, *parts: str) -> str:
    """Join path parts onto a folder or URI (``s3a://b/x``, ``hdfs://n/x``,
    ``file:/x`` or a plain path) with single slashes; the file system behind
    the scheme is Hadoop's business."""
    out = base.rstrip("/")
    for p in parts:
        out = f"{out}/{p.strip('/')}"
    return out


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided test tables, e.g. ``load(spark, dir, "lineitem")``."""
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str | None = None,
    schema: StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read a record table; the format follows the ``.csv`` suffix unless given.

    CSV has a header. A given schema is used as is; inference (one extra pass
    over the data) happens only when no schema is given.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt is None:
        fmt = "csv" if all(p.lower().endswith(".csv") for p in paths) else "parquet"
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths if len(paths) > 1 else paths[0])


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """Rows held by the driver as a table: for fixtures and small lists only."""
    return spark.createDataFrame(list(rows), schema)


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Tag every row of a file-based scan with the file it came from."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def read_sources(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    fmt: str = "csv",
    skip_prefix: str | None = "deduplicated_",
    **options,
) -> DataFrame:
    """Many input files as ONE scan, each row tagged with ``source_file``.

    Files whose base name starts with ``skip_prefix`` (earlier outputs) are
    left out by a filter on the file metadata, which prunes whole files.
    Malformed CSV rows do not stop the read: they land in ``_corrupt_record``
    (PERMISSIVE mode) so a report can count them.
    """
    reader = spark.read.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true").option("mode", "PERMISSIVE")
    df = reader.load(paths if isinstance(paths, str) else list(paths))
    if skip_prefix:
        df = df.filter(~F.col("_metadata.file_name").startswith(skip_prefix))
    return with_source_file(df)


def read_lines(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Text scan with the source file: one row per line, or per file when
    ``whole_file`` (then the row is the file's full text)."""
    df = spark.read.option("wholetext", str(whole_file).lower()).text(path)
    return with_source_file(df, "file_path")
