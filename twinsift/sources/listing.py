"""A source of file listings: one row a file, files without bytes included,
as a batch or as a stream of arrivals.

The driver looks for folders only (it walks down until there are ``want`` of
them or no more) and keeps no file's name; a task lists what lies in and below
a folder, in batches. So a tree of any size is listed by as many tasks as it
has folders; a single flat folder is listed by one task, a batch of names at a
time. Names that begin with ``_`` or ``.`` are passed over, as Spark's own
file sources do.

As a stream, the offset is a time: a batch has the files changed from the last
offset on and before this one, so no list of seen files is kept anywhere. Files
that are moved in with an older time are found if it is within
``lateness_seconds`` of the last offset; files that were listed already may then
come again, so pair it with a sink that drops what it has (``SeenTableSink``).

Options: ``path``, ``glob`` (of base names, with ``{a,b}``), ``recursive``,
``want``, ``lateness_seconds``, ``settle_seconds`` (younger files wait for the
next batch).
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from twinsift.functions import digest
from twinsift.functions.digest import open_path

# pickled by value: executors need pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(digest)

NAME = "twinsift_files"
SCHEMA = "file_path string, file_name string, file_size bigint, modified timestamp"
BATCH = 10_000


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def glob_pattern(glob: str) -> str:
    """A glob of base names as a regular expression."""
    import fnmatch
    import re

    found = re.search(r"\{([^{}]*)\}", glob)
    if not found:
        return fnmatch.translate(glob)
    return "|".join(f"(?:{glob_pattern(glob[: found.start()] + part + glob[found.end() :])})" for part in found[1].split(","))


def _uri(path: str) -> str:
    """The root as rows show it: ``file:/a/b`` or the URI itself."""
    fs, rel = open_path(path)
    return f"file:{rel.rstrip('/')}" if path.startswith("file:") or "://" not in path else path.rstrip("/")


def entries(uri: str) -> Iterator[tuple[str, bool, int, float]]:
    """(name, whether it is a folder, bytes, time of change) in a folder; a
    folder that is gone has none."""
    import pyarrow.fs as pafs

    fs, rel = open_path(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        try:
            with os.scandir(rel) as found:
                for e in found:
                    try:
                        stat = e.stat()
                        yield e.name, e.is_dir(), stat.st_size, stat.st_mtime
                    except FileNotFoundError:
                        continue
        except (FileNotFoundError, NotADirectoryError):
            return
    else:
        for info in fs.get_file_info(pafs.FileSelector(rel, allow_not_found=True)):
            yield info.base_name, info.type == pafs.FileType.Directory, info.size or 0, (info.mtime_ns or 0) / 1e9


def expand(path: str) -> Iterator[tuple[str, str, int]]:
    """(uri, name, bytes) of the files that a path means: itself, the files in
    the folder, or what its globs match (in any of its parts)."""
    import re

    import pyarrow.fs as pafs

    parts = _uri(path).split("/")
    at = next((k for k, p in enumerate(parts) if re.search(r"[*?\[{]", p)), None)
    if at is None:
        uri = "/".join(parts)
        fs, rel = open_path(uri)
        info = fs.get_file_info(rel)
        if info.type == pafs.FileType.File:
            yield uri, info.base_name, info.size or 0
        else:
            yield from ((f"{uri}/{n}", n, size) for n, is_folder, size, _ in entries(uri) if not is_folder and not _hidden(n))
        return
    base, wanted = "/".join(parts[:at]), re.compile(glob_pattern(parts[at]))
    for name, is_folder, size, _ in entries(base):
        if not _hidden(name) and wanted.fullmatch(name):
            if is_folder:
                yield from expand("/".join([base, name, *parts[at + 1 :]]))
            elif at + 1 == len(parts):
                yield f"{base}/{name}", name, size


def expand_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A ``mapInArrow`` function: paths, folders and globs -> their files."""
    from itertools import islice

    for b in batches:
        for path in b.column(0).to_pylist():
            found = expand(path)
            while rows := list(islice(found, BATCH)):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["file_path", "file_name", "file_size"])


class Folder(InputPartition):
    """A folder to list, and whether what is below it goes along."""

    def __init__(self, uri: str, below: bool, since: float | None = None, before: float | None = None):
        self.uri, self.below, self.since, self.before = uri, below, since, before


class Lister:
    """What the batch and the stream reader share."""

    def __init__(self, options):
        if not options.get("path"):
            raise ValueError(f"{NAME}: the option path is needed")
        self.root = _uri(options["path"])
        self.glob = options.get("glob")
        self.recursive = str(options.get("recursive", "false")).lower() == "true"
        self.want = int(options.get("want", "64"))

    def folders(self, since: float | None = None, before: float | None = None) -> list[Folder]:
        single = [Folder(self.root, False, since, before)]
        if not self.recursive:
            return single
        done, level = [], [self.root]
        while level and len(done) + len(level) < self.want:
            done += [Folder(u, False, since, before) for u in level]
            level = [f"{u}/{name}" for u in level for name, is_folder, _, _ in entries(u) if is_folder and not _hidden(name)]
        return done + [Folder(u, True, since, before) for u in level]

    def rows(self, part: Folder) -> Iterator[pa.RecordBatch]:
        import re

        wanted = re.compile(glob_pattern(self.glob)) if self.glob else None
        fields = pa.schema([("file_path", pa.string()), ("file_name", pa.string()), ("file_size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC"))])
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], fields.field(k).type) for k in range(4)], schema=fields)
            held.clear()
            return out

        todo = [part.uri]
        while todo:
            uri = todo.pop()
            for name, is_folder, size, changed in entries(uri):
                if _hidden(name):
                    continue
                if is_folder:
                    if part.below:
                        todo.append(f"{uri}/{name}")
                elif (wanted is None or wanted.fullmatch(name)) and (part.since is None or part.since <= changed < part.before):
                    held.append((f"{uri}/{name}", name, size, int(changed * 1_000_000)))
                    if len(held) >= BATCH:
                        yield batch()
        if held:
            yield batch()


class BatchReader(DataSourceReader):
    def __init__(self, options):
        self.lister = Lister(options)

    def partitions(self) -> list[Folder]:
        return self.lister.folders()

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        return self.lister.rows(partition)


class ArrivalReader(DataSourceStreamReader):
    def __init__(self, options):
        self.lister = Lister(options)
        self.lateness = float(options.get("lateness_seconds", "0"))
        self.settle = float(options.get("settle_seconds", "0"))

    def initialOffset(self) -> dict:
        return {"before": 0.0}

    def latestOffset(self) -> dict:
        return {"before": time.time() - self.settle}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return self.lister.folders(max(0.0, start["before"] - self.lateness), end["before"])

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        return self.lister.rows(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema) -> ArrivalReader:
        return ArrivalReader(self.options)


def register(spark) -> None:
    """Make the source known to the session (again does nothing new)."""
    spark.dataSource.register(FileListing)
