"""Embedding near-duplicates through a pivot-permutation index.

Every vector is described by its ``nearest`` reference points (pivots) in
order. Inverted lists go from a pivot to the vectors that have it among
their nearest; two vectors that share at least ``shared`` pivots are
candidates and are verified by their cosine in double precision. A pair that
meets in several lists is counted only in that of its smallest common pivot.

The pivots are a bounded sample: about ``4 * sqrt(n)`` distinct vectors, at
most ``most_pivots`` (they alone are sent to all tasks). Every vector is
indexed. A list is cut into tiles of about ``tile`` vectors and each pair of
tiles is a group of its own, so that a crowded pivot goes to many tasks.
Lists are never capped. Links are added up per vector; a tile pair hands
on a spanning forest of them, never all pairs.

Equal vectors fold into one (their number counts as links). Null, empty, zero
vectors and such with null or non-finite components link with nothing, nor do
vectors of different lengths. A null id stays null, counts as a vector that
others can link to and never names a component. Repeated rows are rows of
their own. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import groups, stage
from twinsift.llm.components import components
from twinsift.llm.simhash_tiles import forest


def _matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)  # keeps squares in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def permutation(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The ``nearest`` pivots of unit rows, nearest first."""
    k = min(nearest, len(pivots))
    sims = x @ pivots.T
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < len(pivots) else np.tile(np.arange(k), (len(x), 1))
    order = np.argsort(-np.take_along_axis(sims, top, 1), axis=1, kind="stable")
    return np.take_along_axis(top, order, 1)


def _candidates(p: np.ndarray, q: np.ndarray, pivot: int, shared: int, n_pivots: int) -> np.ndarray:
    """True where rows of p and q share enough pivots and ``pivot`` is the
    smallest that they share."""
    a, b = np.zeros((len(p), n_pivots), np.float32), np.zeros((len(q), n_pivots), np.float32)
    np.put_along_axis(a, p, 1, 1)
    np.put_along_axis(b, q, 1, 1)
    used = np.flatnonzero(a.any(0) & b.any(0))
    counts = a[:, used] @ b[:, used].T
    low = used[used < pivot]
    first = (a[:, low] @ b[:, low].T) == 0 if len(low) else True
    return (counts >= shared) & first


def links(distinct: DataFrame, threshold: float = 0.95, nearest: int = 8, shared: int = 3, tile: int = 512, most_pivots: int = 2048) -> DataFrame:
    """``distinct(v, dim, x, w)``: a key, the length, the vector and how many
    rows have it -> ``(v, n, root)``: over all lists the weight of the other
    vectors that v is linked to, and smaller keys that it is linked with."""
    n = distinct.count()
    pick = min(most_pivots, max(16, int(4 * math.sqrt(max(n, 1)))))
    sample = distinct.select("dim", "x", "v").orderBy(F.xxhash64(F.lit("pivot"), "v")).limit(pick).collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        pivots[dim] = _unit(np.array([r["x"] for r in sample if r["dim"] == dim], np.float64)).astype(np.float32)

    def describe(xs: pa.Array) -> pa.Array:
        sizes = np.diff(np.asarray(xs.offsets))
        out: list = [None] * len(xs)
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            x = _unit(_matrix(xs.take(pa.array(at)), int(dim)))
            got = permutation(x.astype(np.float32), pivots[int(dim)], nearest) if int(dim) in pivots else np.zeros((len(at), 1), int)
            for i, row in zip(at.tolist(), got.tolist(), strict=True):
                out[i] = row
        return pa.array(out, pa.list_(pa.int32()))

    index = stage(distinct.withColumn("p", F.arrow_udf(describe, "array<int>")("x")), "pivots")
    lists = index.select("v", "dim", "x", "w", "p", F.explode("p").alias("pivot"))
    tiles = index.select("dim", F.explode("p").alias("pivot")).groupBy("dim", "pivot").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("k"))
    own = lists.join(tiles, ["dim", "pivot"]).withColumn("own", F.pmod(F.xxhash64(F.lit("tile"), "v"), F.col("k")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    met = met.select("dim", "pivot", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") <= F.col("other")).cast("int").alias("side"), "v", "w", "x", "p")
    key = ["dim", "pivot", "a", "b"]

    def compare(batches):
        for (dim, pivot, a, b), t in groups(batches, key):
            v, w, side = (np.asarray(t[c].combine_chunks()) for c in ("v", "w", "side"))
            x, plist = _unit(_matrix(t["x"], dim)), t["p"].combine_chunks()
            p = np.asarray(plist.flatten()).reshape(len(v), -1)
            n_pivots = int(p.max()) + 1
            same = a == b
            left, right = (np.arange(len(v)),) * 2 if same else (np.flatnonzero(side == 1), np.flatnonzero(side == 0))
            need = min(shared, p.shape[1])
            i, j = np.nonzero(_candidates(p[left], p[right], pivot, need, n_pivots))
            i, j = left[i], right[j]
            if same:
                i, j = i[i < j], j[i < j]
            ok = np.concatenate([np.einsum("ij,ij->i", x[i[s : s + 65536]], x[j[s : s + 65536]]) >= threshold for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            total = np.bincount(i, w[j], len(v)) + np.bincount(j, w[i], len(v))
            order = np.argsort(v)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(v))
            root = order[forest(len(v), iter([(rank[i], rank[j])]))[rank]]
            out = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(v[out]), pa.array(total[out].astype(np.int64)), pa.array(v[root[out]])], ["v", "n", "root"])

    return met.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, "v long, n long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector: str = "embedding", **index) -> DataFrame:
    """One row a vector: ``(vec_id, n_links, component_id, kept)``."""
    x = F.col(vector).cast("array<double>")
    sound = F.coalesce((F.size(x) > 0) & F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False))) & F.exists(x, lambda e: e != 0), F.lit(False))
    # adding zero turns -0.0 into 0.0, so that equal vectors have equal keys
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(sound, F.transform(x, lambda e: e + F.lit(0.0))).alias("x"))
    rows = stage(rows.withColumn("h", F.when(F.col("x").isNotNull(), F.xxhash64("x"))), "vectors")
    # h only deals the rows; vectors are told apart by their values and numbered as they are written
    same = rows.where("x is not null").groupBy("h", "x").agg(F.count("*").alias("w"), F.min("vec_id").alias("first"))
    distinct = stage(same.withColumn("v", F.monotonically_increasing_id()).withColumn("dim", F.size("x")), "distinct-vectors")
    found = stage(links(distinct.select("v", "dim", "x", "w"), threshold, **index), "vector-links")
    counts = found.groupBy("v").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("v").alias("a"), F.col("root").alias("b")))
    whole = distinct.select("v", "h", "x", "w", "first").join(counts, "v", "left").join(roots, F.col("v") == F.col("node"), "left")
    whole = stage(whole.select("h", "x", "first", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "v").alias("root")), "vector-roots")
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = whole.join(least, "root").select("h", "x", "n_links", "component_id")
    linked = rows.where("x is not null").join(facts, ["h", "x"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
