"""SimHash near-duplicates: 64-bit fingerprints compared exactly in tiles.

Equal fingerprints fold into one. The others are dealt by blocks: a radius of
r differing bits leaves one of r + 1 bit blocks untouched, so two
fingerprints within the radius meet in a bucket (block, its value). Inside a
bucket the fingerprints are sorted by population count and cut into tiles;
tile pairs whose population counts differ beyond the radius are skipped, all
others are compared bit by bit (numpy exclusive-or and bit counts). A bucket
beyond ``bucket`` fingerprints is dealt out again by its population counts
and a salt, so its tile pairs go to many tasks. Nothing is left out: the result is exact. A
bucket gives one link for each fingerprint that is not alone, never all pairs.

Null and empty texts have fingerprint zero and are linked like any other.
Rows with a null id get a fingerprint and their group, but never name it
unless all its ids are null (then the component is null). Repeated rows are
members of one group. Long texts are hashed whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import groups, own_names, stage, text_or_empty
from twinsift.llm.components import components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
TILE = 1024


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bit i is set if it is set in over half the shingles' XXH64 (seed 42)."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes split at the six ASCII blanks
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[a : a + (1 << 15)]).astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, f)``: the fingerprint as a signed long."""

    def each(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).astype(np.int64), pa.int64())

    return docs.select(F.col(id_col).alias("doc_id"), F.arrow_udf(each, "long")(text_or_empty(text)).alias("f"))


def near(f: np.ndarray, g: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into f, into g) within the radius, tile by tile. Both are
    sorted by population count; tiles too far apart in it are skipped."""
    pf, pg = np.bitwise_count(f).astype(int), np.bitwise_count(g).astype(int)
    same = f is g
    for a in range(0, len(f), TILE):
        fa, top = f[a : a + TILE], pf[min(a + TILE, len(f)) - 1]
        for b in range(a if same else 0, len(g), TILE):
            gb = g[b : b + TILE]
            if pg[b] - top > radius:
                break
            if pf[a] - pg[min(b + TILE, len(g)) - 1] > radius:
                continue
            i, j = np.nonzero(np.bitwise_count(fa[:, None] ^ gb[None, :]) <= radius)
            if same and a == b:
                i, j = i[i < j], j[i < j]
            yield i + a, j + b


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each index is linked to, directly or not."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            low = np.minimum(a, b)
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root[root] != root).any():
                root = root[root]
            open_ = root[i] != root[j]
            i, j = i[open_], j[open_]
    return root


def _order(f: np.ndarray) -> np.ndarray:
    return f[np.lexsort((f, np.bitwise_count(f)))]


def _links(f: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    moved = np.flatnonzero(root != np.arange(len(f)))
    return pa.RecordBatch.from_arrays([pa.array(f[moved].view(np.int64)), pa.array(f[root[moved]].view(np.int64))], ["a", "b"])


def links(distinct: DataFrame, radius: int = 4, bucket: int = 8 * TILE) -> DataFrame:
    """``distinct(f)`` -> ``(a, b)``: a forest that spans every set of
    fingerprints linked within the radius inside some bucket."""
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    value = [F.shiftrightunsigned("f", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    parts = distinct.select("f", F.posexplode(F.array(*value)).alias("k", "v")).withColumn("p", F.bit_count("f"))
    sizes = parts.groupBy("k", "v", "p").agg(F.count("*").alias("n")).groupBy("k", "v").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("p", "n"))).alias("by"))  # at most 65 counts
    big = sizes.where(F.col("n") > bucket)
    some = big.select("k", "v", "by")
    small = parts.join(big.select("k", "v"), ["k", "v"], "left_anti")

    def whole(batches):
        for _, t in groups(batches, ["k", "v"]):
            f = _order(np.asarray(t["f"].combine_chunks()).view(np.uint64))
            yield _links(f, forest(len(f), near(f, f, radius)))

    one = small.select("k", "v", "f").repartition("k", "v").sortWithinPartitions("k", "v").mapInArrow(whole, "a long, b long")
    # crowded buckets: cells (population count, salt) of about ``bucket`` / 2 rows; every pair of cells within the radius is a task's group
    half = bucket // 2
    cells = parts.join(some, ["k", "v"])
    salt = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(half))).cast("int")
    own = F.pmod(F.xxhash64(F.lit("cell"), "f"), salt(F.col("by")[F.col("p")])).cast("int")
    near_by = F.filter(F.map_keys("by"), lambda q: F.abs(q - F.col("p")) <= radius)
    partners = F.flatten(F.transform(near_by, lambda q: F.transform(F.sequence(F.lit(0), salt(F.col("by")[q]) - 1), lambda s: F.struct(q.alias("p"), s.alias("s")))))
    met = cells.withColumn("s", own).select("k", "v", "f", "p", "s", F.explode(partners).alias("o"))
    mine = F.struct("p", "s")
    pairs = met.select("k", "v", "f", F.least(mine, F.col("o")).alias("x"), F.greatest(mine, F.col("o")).alias("y"), (mine <= F.col("o")).cast("int").alias("side"))
    pairs = pairs.select("k", "v", F.col("x.p").alias("xp"), F.col("x.s").alias("xs"), F.col("y.p").alias("yp"), F.col("y.s").alias("ys"), "side", "f")
    key = ["k", "v", "xp", "xs", "yp", "ys"]

    def across(batches):
        for at, t in groups(batches, key):
            f, side = np.asarray(t["f"].combine_chunks()).view(np.uint64), np.asarray(t["side"].combine_chunks())
            if at[2:4] == at[4:6]:
                g = _order(f)
                yield _links(g, forest(len(g), near(g, g, radius)))
            else:
                x, y = _order(f[side == 1]), _order(f[side == 0])
                yield _links(np.concatenate([x, y]), forest(len(f), ((i, j + len(x)) for i, j in near(x, y, radius))))

    two = pairs.repartition(*key).sortWithinPartitions(*key).mapInArrow(across, "a long, b long")
    return one.unionByName(two)


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row a document: ``(doc_id, fingerprint, component_id)``; the
    component is the smallest id that links within ``radius`` bits reach."""
    prints = stage(fingerprints(docs, shingle, text, id_col), "simhash")
    first = stage(prints.groupBy("f").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(first.select("f"), radius))
    named = first.join(roots, F.col("f") == F.col("node"), "left").select("f", "first", F.coalesce("root", "f").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = named.join(least, "root").select(F.col("f").alias("g"), "component_id")
    got = prints.join(whole, F.col("f") == F.col("g"))  # many rows to one: a crowded fingerprint can be split
    return got.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


@own_names
def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id names its group. Of repeated rows with
    one id any one stays; groups without any id keep all rows."""
    named = near_duplicates(docs, shingle, radius, text, id_col)
    gone = stage(named.where("doc_id <> component_id or (doc_id is null and component_id is not null)").select(F.col("doc_id").alias("__gone")).distinct(), "simhash-gone")
    kept = docs.join(gone.hint("merge"), F.col(id_col).eqNullSafe(F.col("__gone")), "left_anti")
    repeats = named.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1)
    return kept.dropDuplicates([id_col]) if repeats.count() else kept
