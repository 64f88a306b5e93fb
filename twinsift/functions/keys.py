"""Key expressions: normalisation and row fingerprints.

All of these are built-in Column expressions, so they stay inside
whole-stage codegen; none of them needs Python at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMALIZE_STEPS = ("nulls", "lower", "trim")


def normalized(col: str | Column, steps: Sequence[str] = NORMALIZE_STEPS) -> Column:
    """Normalised key value.

    ``nulls``: NULL becomes ``''``; ``lower``: lower case; ``trim``: strip
    blanks at both ends (spaces only, like SQL ``trim``). With all three steps
    NULL, ``''`` and ``'  '`` are the same key.
    """
    c = F.col(col) if isinstance(col, str) else col
    unknown = set(steps) - set(NORMALIZE_STEPS)
    if unknown:
        raise ValueError(f"unknown normalisation steps: {sorted(unknown)}")
    if "nulls" in steps:
        c = F.coalesce(c.cast("string"), F.lit(""))
    if "lower" in steps:
        c = F.lower(c)
    if "trim" in steps:
        c = F.trim(c)
    return c


def normalize_columns(
    df: DataFrame,
    columns: Sequence[str] = ("name", "email", "address"),
    steps: Sequence[str] = NORMALIZE_STEPS,
    inplace: bool = False,
    suffix: str = "_normalized",
) -> DataFrame:
    """Add ``<c>_normalized`` for each column (or replace the column itself
    when ``inplace``) in a single projection."""
    out = []
    targets = set(columns)
    for name in df.columns:
        if inplace and name in targets:
            out.append(normalized(name, steps).alias(name))
        else:
            out.append(F.col(name))
    if not inplace:
        out.extend(normalized(c, steps).alias(f"{c}{suffix}") for c in columns)
    return df.select(*out)


def _as_text(columns: Sequence[str | Column], nulls_as_empty: bool) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if nulls_as_empty:
        return [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return [c.cast("string") for c in cols]


HASH_TYPES = ("md5", "sha256")


def checksum(columns: Sequence[str | Column], hash_type: str = "md5", sep: str = "|") -> Column:
    """Hex digest of the ``sep``-joined values with NULL written as ``''``.

    Equal to hashing ``"|".join(str(v) if v is not None else "")`` for string
    columns. Other types are cast to string by Spark's rules.
    """
    text = F.concat_ws(sep, *_as_text(columns, nulls_as_empty=True))
    if hash_type == "md5":
        return F.md5(text)
    if hash_type == "sha256":
        return F.sha2(text, 256)
    raise ValueError(f"hash_type must be one of {HASH_TYPES}, got {hash_type!r}")


def concat_hash(columns: Sequence[str | Column], sep: str = "|") -> Column:
    """MD5 of ``concat_ws``: NULL values vanish together with their separator,
    so ``('a', NULL, 'b')`` and ``('a', 'b', NULL)`` hash alike."""
    return F.md5(F.concat_ws(sep, *_as_text(columns, nulls_as_empty=False)))


def json_fingerprint(columns: Sequence[str | Column]) -> Column:
    """MD5 of the JSON array of the values: delimiter-safe and keeps NULL
    positions, so it never merges rows that differ. Column order matters."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.to_json(F.array(*[c.cast("string") for c in cols])))


def hash64(columns: Sequence[str | Column]) -> Column:
    """64-bit xxHash of the columns. A prefilter only: equal hashes must be
    verified by comparing the key values themselves."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in columns])


def bucket_of(columns: Sequence[str | Column], n: int) -> Column:
    """Bucket number in ``[0, n)`` from Murmur3; ``pmod`` never overflows,
    unlike ``abs(hash) % n`` which fails on the minimum int under ANSI mode."""
    return F.pmod(F.hash(*[F.col(c) if isinstance(c, str) else c for c in columns]), F.lit(n))


def basename(path: str | Column) -> Column:
    """Last segment of a ``/``-separated path or URI."""
    c = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(c, "/"), -1)


def tokens(col: str | Column) -> Column:
    """Lower-case tokens split on single whitespace characters (like MLlib's
    ``Tokenizer``: leading blanks give empty tokens)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(F.lower(c), r"\s")


def digest_bucket(column: str, n: int) -> Column:
    """Bucket 0..n-1 of the value's md5: any engine can compute the same."""
    return F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 8), 16, 10).cast("bigint") % n


def fresh(name: str, *frames) -> str:
    """A column name that none of the frames has (case-insensitively)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
