"""Choosing survivors: one row per key by an order, latest wins, most
complete record, and merging a group into one record.

The survivor is always defined by a TOTAL order (the requested order, then
every remaining orderable column), so results are repeatable and checkable.
``row_number() == 1`` lets Catalyst insert a ``WindowGroupLimit`` on both
sides of the exchange: a hot key is cut to one row per map partition before
it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

KeyLike = str | Column


def _key_columns(df: DataFrame, keys: Sequence[KeyLike]) -> tuple[DataFrame, list[str], list[str]]:
    """Materialise expression keys as hidden columns; return (df, key names, hidden)."""
    names, hidden = [], []
    for i, k in enumerate(keys):
        if isinstance(k, str):
            if isinstance(df.schema[k].dataType, MapType):
                raise TypeError(f"map column {k!r} cannot be a deduplication key")
            names.append(k)
        else:
            name = f"__key{i}"
            df = df.withColumn(name, k)
            names.append(name)
            hidden.append(name)
    return df, names, hidden


def _orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in exclude and not isinstance(f.dataType, MapType)]


def total_order(
    df: DataFrame,
    order_by: Sequence[KeyLike] = (),
    keep: str = "first",
    exclude: Sequence[str] = (),
) -> list[Column]:
    """Order columns for survivor choice.

    ``keep='last'`` reverses only the requested order columns (NULLs last);
    the tie-break over the remaining columns is always ascending, NULLs first.
    """
    cols: list[Column] = []
    used = set(exclude)
    for o in order_by:
        c = F.col(o) if isinstance(o, str) else o
        cols.append(c.desc_nulls_last() if keep == "last" else c.asc_nulls_first())
        if isinstance(o, str):
            used.add(o)
    cols.extend(F.col(c).asc_nulls_first() for c in _orderable(df, list(used)))
    return cols or [F.lit(0)]


def keep_one(
    df: DataFrame,
    keys: Sequence[KeyLike],
    order_by: Sequence[KeyLike] = (),
    keep: str = "first",
) -> DataFrame:
    """One row per key: the first by ``order_by`` (``keep='last'``: the last).

    Any ``keep`` other than ``'last'`` means first. Keys may be expressions;
    the output has the input's columns only.
    """
    original = df.columns
    df, key_names, hidden = _key_columns(df, keys)
    window = Window.partitionBy(*key_names).orderBy(*total_order(df, order_by, keep, exclude=key_names))
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") == 1).select(*original)


def repeats(df: DataFrame, keys: Sequence[KeyLike], order_by: Sequence[KeyLike] = ()) -> DataFrame:
    """Every row after the first of its key: the complement of ``keep_one``.

    Never sorts a whole key group in one task: equal rows are counted by an
    aggregate, the survivor is chosen among DISTINCT rows (``keep_one``,
    limited before its shuffle), and each distinct row is emitted as many
    times as it repeats (its count, minus one for the survivor)."""
    original = df.columns
    counted = df.groupBy(*original).agg(F.count(F.lit(1)).alias("__n"))
    renamed = [f"__s{i}" for i in range(len(original))]
    survivors = keep_one(counted, keys, order_by=order_by).select(
        *[F.col(c).alias(r) for c, r in zip(original, renamed)], F.lit(1).alias("__kept")
    )
    cond = None
    for c, r in zip(original, renamed):
        term = F.col(c).eqNullSafe(F.col(r))
        cond = term if cond is None else cond & term
    joined = counted.join(survivors, cond, "left").select(
        *original, (F.col("__n") - F.coalesce(F.col("__kept"), F.lit(0))).alias("__extra")
    )
    # a row's copies are made in blocks, and the blocks dealt out before they
    # are unrolled: a row that is a third of the table fills no array and no task
    block = 4096
    blocks = joined.filter(F.col("__extra") > 0).select(
        *original, "__extra", F.explode(F.sequence(F.lit(0), F.expr(f"(__extra - 1) div {block}"))).alias("__block")
    )
    blocks = blocks.withColumn("__n", F.least(F.lit(block), F.col("__extra") - F.col("__block") * block).cast("int"))
    dealt = blocks.repartition(F.xxhash64("__block", *hashable(df, original)))
    return dealt.select(*original, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__copy")).drop("__copy")


def hashable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that can be hashed (maps and variants can't)."""
    return [c for c in columns if not any(t in df.schema[c].dataType.simpleString() for t in ("map<", "variant"))]


def latest_wins(existing: DataFrame, new: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Existing rows and new rows together; per key the one with the latest ``ts``."""
    return keep_one(existing.unionByName(new), keys, order_by=[ts], keep="last")


def non_null_count(columns: Sequence[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def keep_most_complete(
    df: DataFrame,
    keys: Sequence[KeyLike],
    id_col: str = "id",
    length_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Per key the most complete row: most non-NULL values, then the longest
    text in ``length_cols``, then the highest ``id_col``."""
    value_cols = [c for c in df.columns if c != id_col]
    length_cols = list(length_cols) if length_cols is not None else value_cols
    total_length = sum((F.coalesce(F.length(c), F.lit(0)) for c in length_cols), F.lit(0))
    return keep_one(
        df,
        keys,
        order_by=[non_null_count(value_cols), total_length, F.col(id_col)],
        keep="last",
    )


def merge_records(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One record per key whose every column is the first non-NULL value of
    that column in ``order_by`` order (ties broken by the value itself).

    A plain aggregate: partial aggregation runs before the shuffle, so a hot
    key is reduced map-side.
    """
    aggs = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(order_by), F.col(c)))).alias(c)
        for c in df.columns
        if c not in keys
    ]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)
