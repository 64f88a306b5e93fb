"""Similar-value joins without a cross product.

Pairs are found among DISTINCT values (a value repeated a million times is
one candidate), with exact blocking by the pigeonhole principle (Pass-Join,
Li et al., VLDB 2011): cut the value ``s`` into ``tau + 1`` segments; if
``r`` is within ``tau`` edits of ``s``, one segment of ``s`` appears
untouched in ``r``; by the position-aware selection of Pass-Join, some
untouched segment ``i`` is shifted by at most ``i`` and lies within
``tau - i`` of its place counted from the end. Each value emits its segments
(index side) and the substrings where a partner's segment could sit (probe
side); an equi-join on ``(len_s, len_r, segment no, text)`` gives
candidates, which are then verified exactly. No pair within the threshold
is lost, and no pair outside it is returned.

The same blocking serves the similarity ratio: a ratio >= T bounds the
insert/delete distance by ``(len_s + len_r) * (100.5 - T) / 100``, and a
bound on that distance bounds the edit distance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.functions.similarity import edit_distance, ratio

TauFn = Callable[[str, str], str]


def _segment_sql(length: str, tau: str, i: str) -> tuple[str, str]:
    """(start, len) SQL of segment ``i`` when a string of ``length`` is cut
    into ``tau + 1`` pieces: the last ``length % (tau+1)`` pieces are one
    longer. Pieces are empty when the string is shorter than ``tau + 1``."""
    n = f"({tau} + 1)"
    base = f"({length} DIV {n})"
    short = f"({n} - {length} % {n})"
    seg_len = f"({base} + CASE WHEN {i} >= {short} THEN 1 ELSE 0 END)"
    start = f"({i} * {base} + greatest(0, {i} - {short}))"
    return start, seg_len


def _partners(length: str, lo: str, hi: str, tau: TauFn) -> str:
    return f"filter(sequence({lo}, {hi}), x -> x >= 0 AND abs({length} - x) <= {tau(length, 'x')})"


def _index_sql(tau: TauFn, lo: Callable[[str], str], hi: Callable[[str], str]) -> str:
    start, seg_len = _segment_sql("L", tau("L", "x"), "i")
    return (
        f"flatten(transform({_partners('L', lo('L'), hi('L'), tau)}, x -> "
        f"transform(sequence(0, {tau('L', 'x')}), i -> named_struct("
        f"'ls', L, 'lr', x, 'i', i, 'seg', substring(v, {start} + 1, {seg_len})))))"
    )


def _probe_sql(tau: TauFn, lo: Callable[[str], str], hi: Callable[[str], str]) -> str:
    t = tau("x", "L")
    start, seg_len = _segment_sql("x", t, "i")
    # position-aware selection (Pass-Join): segment i may shift by at most i
    # (edits before it) and, seen from the end, by at most tau - i around
    # the length difference (edits after it)
    delta = "(L - x)"
    p_lo = f"greatest(0, {start} - i, {start} + {delta} - ({t} - i))"
    p_hi = f"least(L - {seg_len}, {start} + i, {start} + {delta} + ({t} - i))"
    positions = f"CASE WHEN {p_lo} <= {p_hi} THEN sequence({p_lo}, {p_hi}) ELSE CAST(array() AS array<int>) END"
    return (
        f"flatten(flatten(transform({_partners('L', lo('L'), hi('L'), tau)}, x -> "
        f"transform(sequence(0, {t}), i -> transform({positions}, p -> named_struct("
        f"'ls', x, 'lr', L, 'i', i, 'seg', substring(v, p + 1, {seg_len})))))))"
    )


def candidate_pairs(values: DataFrame, tau: TauFn, lo: Callable[[str], str], hi: Callable[[str], str]) -> DataFrame:
    """Distinct unordered candidate pairs ``(value_a < value_b)`` of the
    distinct non-NULL values in the single column of ``values``."""
    col = values.columns[0]
    v = values.select(F.col(col).alias("v")).filter(F.col("v").isNotNull()).distinct()
    v = v.withColumn("L", F.length("v"))
    index = v.select(F.col("v").alias("s"), F.inline(F.expr(_index_sql(tau, lo, hi))))
    probe = v.select(F.col("v").alias("r"), F.inline(F.expr(_probe_sql(tau, lo, hi))))
    joined = index.join(probe, ["ls", "lr", "i", "seg"]).filter(F.col("s") != F.col("r"))
    return joined.select(F.least("s", "r").alias("value_a"), F.greatest("s", "r").alias("value_b")).distinct()


def edit_pairs(values: DataFrame, threshold: int = 2) -> DataFrame:
    """``value_a, value_b, distance`` for distinct values within
    ``threshold`` edits (Levenshtein, code points), ``value_a < value_b``."""
    t = int(threshold)
    cands = candidate_pairs(
        values,
        tau=lambda a, b: str(t),
        lo=lambda n: f"greatest(0, {n} - {t})",
        hi=lambda n: f"{n} + {t}",
    )
    d = edit_distance("value_a", "value_b", t)
    return cands.select("value_a", "value_b", d.cast("bigint").alias("distance")).filter(F.col("distance") >= 0)


def ratio_pairs(values: DataFrame, threshold: int = 85) -> DataFrame:
    """``value_a, value_b, ratio`` for distinct values with similarity ratio
    at least ``threshold`` (0-100). Only blocked candidates are scored."""
    thr = int(threshold)
    num = 1005 - 10 * thr  # tau = (la + lb) * num / 1000, rounded down
    f = num / 1000.0
    cands = candidate_pairs(
        values,
        tau=lambda a, b: f"((({a}) + ({b})) * {num} DIV 1000)",
        lo=lambda n: f"CAST(floor({n} * {(1 - f) / (1 + f)!r}) AS INT)",
        hi=lambda n: f"CAST(ceil({n} * {(1 + f) / (1 - f)!r}) AS INT) + 1",
    )
    scored = cands.select("value_a", "value_b", ratio("value_a", "value_b").cast("bigint").alias("ratio"))
    return scored.filter(F.col("ratio") >= thr)


def column_edit_pairs(df: DataFrame, columns: list[str], threshold: int = 2, key: Callable[[str], Column] | None = None) -> DataFrame:
    """Edit-distance pairs per column: ``column_name, value_a, value_b,
    distance``. ``key`` maps a column name to the compared value (e.g.
    normalised)."""
    out = None
    for c in columns:
        vals = df.select((key(c) if key else F.col(c)).alias("v"))
        part = edit_pairs(vals, threshold).select(F.lit(c).alias("column_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def both_orientations(pairs: DataFrame) -> DataFrame:
    """Each pair twice, as (a, b) and as (b, a): for lookups by one side. The
    pair columns are the first two; the others go along."""
    a, b, *rest = pairs.columns
    return pairs.unionByName(pairs.select(F.col(b).alias(a), F.col(a).alias(b), *rest))
