"""String similarity: edit distance (built in) and the 0-100 similarity
ratio (an Arrow-batched pandas UDF; Spark has no LCS built in)."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# The UDF and its helpers travel with the task (pickled by value), so the
# Python workers need pandas but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def edit_distance(a: str | Column, b: str | Column, threshold: int | None = None) -> Column:
    """Levenshtein distance in code points; with ``threshold`` the value is
    -1 when the distance exceeds it (and the computation stops early)."""
    if threshold is None:
        return F.levenshtein(_col(a), _col(b))
    return F.levenshtein(_col(a), _col(b), threshold)


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel (one big-int
    step per character of ``b``)."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio_value(a: str | None, b: str | None) -> int:
    """Similarity 0-100: round(100 * 2 * LCS / (len(a) + len(b))), halves to
    even; equal strings score 100, otherwise an empty or missing side 0."""
    if a is None or b is None:
        return 0
    if a == b:
        return 100
    if not a or not b:
        return 0
    return int(round(100.0 * 2 * lcs_length(a, b) / (len(a) + len(b))))


@F.pandas_udf(IntegerType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio_value(x, y) for x, y in zip(a, b)], dtype="int32")


def ratio(a: str | Column, b: str | Column) -> Column:
    """Similarity ratio 0-100 of two strings (see ``ratio_value``)."""
    return _ratio_udf(_col(a), _col(b))
