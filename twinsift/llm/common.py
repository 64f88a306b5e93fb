"""Helpers shared by the training-data operators: the shared staging folder,
document columns, and the packed streams that Python tasks exchange."""

from __future__ import annotations

import inspect
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows and, where the setting exists, 8 MB:
    with long texts the usual 10,000 rows fill the buffers of a Python worker
    and of its executor. The setting counts when a plan runs, so it is the
    session's; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is not None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a plain local session
    (tests), where every task runs on this machine, gets one of its own."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="twinsift-llm-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the
    lineage ends there, so a lost executor costs only the tasks it ran."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def added_up(df: DataFrame, share: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, int], dtype: str = "<f8", slices: int = 16) -> np.ndarray:
    """The sum of what ``share`` makes of the batches of every task, a matrix of
    ``shape``. Each task hands back one whole matrix, so there are no more tasks
    than cores, however many parts the rows have; Spark adds up slices of them."""

    def parts(batches):
        for s, x in enumerate(np.array_split(share(batches), slices)):
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([x.astype(dtype).tobytes()], pa.binary())], ["slice", "part"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), dtype).astype(np.float64) for x in table["part"])
        return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "part": pa.array([total.astype(dtype).tobytes()], pa.binary())})

    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    rows = df.coalesce(cores).mapInArrow(parts, "slice int, part binary").groupBy("slice").applyInArrow(add, "slice int, part binary").collect()
    out = np.zeros(shape, np.dtype(dtype).newbyteorder("="))
    places = np.array_split(out, slices)
    for r in rows:
        places[r[0]][:] = np.frombuffer(r[1], dtype).reshape(-1, shape[1])
    return out


def text_or_empty(column: str = "text") -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def own_names(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator's passing columns begin with two underscores. Columns of its
    first argument that do so too are called otherwise while it runs, and get
    their names back in the result."""
    spec = inspect.signature(f)

    @wraps(f)
    def run(docs: DataFrame, *args, **how) -> DataFrame:
        odd = [c for c in docs.columns if c.startswith("__")]
        if not odd:
            return f(docs, *args, **how)
        taken, other = {c.lower() for c in docs.columns}, {}
        for c in odd:
            name = f"input{c}"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            other[c] = name
        given = spec.bind(docs.withColumnsRenamed(other), *args, **how)
        for k in ("text", "id_col"):
            if k in given.arguments:
                given.arguments[k] = other.get(given.arguments[k], given.arguments[k])
        if "metadata" in given.arguments:
            given.arguments["metadata"] = tuple(other.get(c, c) for c in given.arguments["metadata"])
        return f(*given.args, **given.kwargs).withColumnsRenamed({n: c for c, n in other.items()})

    return run


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of plain values that the plan itself holds, so that no
    Python runs for it on the executors (numbers, booleans, names, None)."""
    columns = [c.split() for c in schema.split(", ")]
    cell = lambda v, t: f"CAST({'NULL' if v is None else repr(v).upper() if isinstance(v, bool) else repr(v)} AS {t})"
    told = [f"({', '.join(cell(v, t) for v, (_, t) in zip(r, columns, strict=True))})" for r in rows or [(None,) * len(columns)]]
    got = spark.sql(f"SELECT * FROM VALUES {', '.join(told)} AS t({', '.join(n for n, _ in columns)})")
    return got if rows else got.where("false")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, and where each text starts and ends
    (nulls are empty). No copy is made."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def slices(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together (one text at least)."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of a stream that is sorted by ``keys`` (integers without nulls),
    each as one table; only one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
            key = tuple(int(c[a]) for c in cols)
            if last is not None and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if last is not None:
        yield last, pa.Table.from_batches(held)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wraps around on purpose)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_PLACE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)


def word_hashes(b: np.ndarray, inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes marked ``inside``; a word also ends at each of
    ``edges`` (where texts start). Returns (first byte, bytes, 64-bit hash)."""
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = edges[edges < len(b)]
    start[at] |= inside[at]
    first = np.flatnonzero(start)
    if not len(first):
        return first, first, np.zeros(0, np.uint64)
    stop = inside.copy()  # a word's last byte
    stop[:-1] &= ~inside[1:] | start[1:]
    size = np.flatnonzero(stop) + 1 - first
    head = np.cumsum(size) - size
    # places modulo 256, in single bytes
    place = np.arange(int(size.sum()), dtype=np.uint32).astype(np.uint8) - np.repeat(head.astype(np.uint8), size)
    part = _SPREAD.take(b[inside])
    part *= _PLACE.take(place)
    return first, size, mix(np.add.reduceat(part, head) + size.astype(np.uint64))
