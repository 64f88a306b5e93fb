"""Files as rows. Listings come from the ``twinsift_files`` source (tasks list
folders, files without bytes included); contents are read on the executors, so
neither bytes nor names pass through the driver."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.functions.keys import basename
from twinsift.sources import listing

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_COLUMNS = ("file_path", "file_name", "file_size", "content")


def _source(reader, path: str, glob: str | None, recursive: bool, **options):
    reader = reader.format(listing.NAME).option("path", path).option("recursive", str(recursive).lower())
    if glob:
        reader = reader.option("glob", glob)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False, **options) -> DataFrame:
    """``file_path, file_name, file_size, modified`` of every file in ``path``
    (``recursive``: and below it), those without bytes included; no content is
    read. ``glob`` filters base names (``*.{jpg,png}``)."""
    listing.register(spark)
    return _source(spark.read, path, glob, recursive, **options)


def list_paths(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file_path, file_name, file_size`` of the files that the given paths,
    folders and globs mean; they are looked up by tasks."""
    given = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.createDataFrame([(p,) for p in given], "path string").repartition(max(1, min(len(given), 64)))
    return rows.mapInArrow(listing.expand_batches, "file_path string, file_name string, file_size bigint").distinct()


def stream_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False, **options) -> DataFrame:
    """Streaming form of ``list_files``: files as they arrive (see
    ``sources.listing`` for what counts as arrived)."""
    listing.register(spark)
    return _source(spark.readStream, path, glob, recursive, **options)


def with_content(files: DataFrame) -> DataFrame:
    """Listed files with their whole bytes as ``content`` (NULL where a file
    can't be read any more), read on the executors. For files of any size take
    ``operators.files.hash_listed``, which reads them in chunks."""
    from twinsift.functions.digest import open_path

    def read(path: str) -> bytes | None:
        try:
            fs, rel = open_path(path)
            with fs.open_input_stream(rel) as f:
                return f.read()
        except (OSError, pa.ArrowException):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):  # one file at a time: contents can be large
                row = b.slice(k, 1)
                yield row.append_column("content", pa.array([read(row.column(0)[0].as_py())], pa.binary()))

    return files.select("file_path", "file_name", "file_size").mapInArrow(run, "file_path string, file_name string, file_size bigint, content binary")


def scan_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``list_files`` with contents: ``file_path, file_name, file_size, content``."""
    return with_content(list_files(spark, path, glob, recursive))


def write_files(df: DataFrame, folder: str, name: str | Column, content: str | Column) -> int:
    """Write one file a row below ``folder`` (``name`` may have subfolders) on
    the executors; returns how many. A task that runs again writes the same
    files again."""
    from twinsift.functions.digest import open_path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for b in batches:
            for n, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, rel = open_path(f"{folder.rstrip('/')}/{n}")
                parent = rel.rsplit("/", 1)[0]
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                with fs.open_output_stream(rel) as f:
                    f.write(data or b"")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(as_column(name).alias("name"), as_column(content).cast("binary").alias("content"))
    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def blobs_from_text(df: DataFrame, id_col: str, text_col: str, folder: str | None = None, prefix: str = "doc") -> DataFrame:
    """Treat each row's text as the content of a file (UTF-8 bytes):
    ``file_path`` is ``<prefix>/<folder>/<id padded>.txt``."""
    parts = [F.lit(prefix)]
    if folder:
        parts.append(F.col(folder))
    parts.append(F.concat(F.lpad(F.col(id_col).cast("string"), 9, "0"), F.lit(".txt")))
    path = F.concat_ws("/", *parts)
    return df.select(
        path.alias("file_path"),
        basename(path).alias("file_name"),
        F.octet_length(F.col(text_col)).cast("bigint").alias("file_size"),
        F.encode(F.col(text_col), "UTF-8").alias("content"),
    )
