"""Chunked content digests for files of any size.

Each task opens its files through pyarrow's file systems (local, HDFS, S3,
...) and feeds fixed-size chunks to ``hashlib``; memory per task is one chunk.
The work is partitioned by Spark like any other ``mapInPandas``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle

# pickled by value: executors need pyarrow and pandas, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASH_TYPES = ("md5", "sha256")


def open_path(path: str):
    """(file system, path in it) for a URI or a plain local path. The Hadoop
    names of S3 connectors (``s3a``, ``s3n``) mean the same store as ``s3``."""
    import os
    from urllib.parse import unquote

    import pyarrow.fs as pafs

    if path.startswith("file:"):
        rest = unquote(path[len("file:"):])
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def file_digest(path: str, hash_type: str = "md5", chunk_bytes: int = 8 << 20) -> tuple[str | None, str | None]:
    """(hex digest, None), or (None, reason) for a file that can't be read."""
    import hashlib

    import pyarrow as pa

    if hash_type not in HASH_TYPES:
        raise ValueError(f"hash_type must be one of {HASH_TYPES}, got {hash_type!r}")
    digest = hashlib.new(hash_type)
    try:
        fs, rel = open_path(path)
        with fs.open_input_stream(rel) as f:
            while chunk := f.read(chunk_bytes):
                digest.update(chunk)
    except (OSError, pa.ArrowException) as e:
        return None, f"{type(e).__name__}: {e}"[:300]
    return digest.hexdigest(), None


def digest_batches(hash_type: str, chunk_bytes: int):
    """A ``mapInPandas`` function adding ``file_hash`` and ``error`` to
    batches that carry ``file_path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [file_digest(p, hash_type, chunk_bytes) for p in pdf["file_path"]]
            yield pdf.assign(
                file_hash=pd.Series([h for h, _ in got], index=pdf.index, dtype="object"),
                error=pd.Series([e for _, e in got], index=pdf.index, dtype="object"),
            )

    return run


def stat_batches():
    """A ``mapInPandas`` function: paths -> the files among them that exist,
    with ``file_name`` and ``file_size``; asked where the task runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.fs as pafs

        for pdf in batches:
            rows = []
            for p in pdf["file_path"]:
                try:
                    fs, rel = open_path(p)
                    info = fs.get_file_info(rel)
                except (OSError, pa.ArrowException):
                    continue
                if info.type == pafs.FileType.File:
                    rows.append((p if ":" in p else f"file:{rel}", info.base_name, info.size))
            yield pd.DataFrame(rows, columns=["file_path", "file_name", "file_size"])

    return run
