"""Line dedup with sharded cuckoo filters in front of exact reference counts.

The store holds, as tables in the shared folder:

* ``postings(key, doc_id)``: which document holds which line, once each;
* ``refs(shard, key, n_docs, last_doc)``: the exact reference counts;
* cuckoo filters, one a shard: 16-bit fingerprints in buckets of four, which
  can be inserted and deleted.

``insert`` asks the filters first: keys that they don't know are new without
a look at the exact table, the rest is counted exactly. ``delete`` takes a
document's lines out again: counts go down, and a key that nobody holds any
more leaves its filter. So the store is after any inserts and deletions what
it would be if built from the remaining documents.

``drop_lines`` sends every line past the filter of the keys that enough
documents hold; what passes is checked against the exact counts, so a false
positive costs a look-up and never a line.

A line's key is a 128-bit hash of the line stripped of ASCII blanks with A-Z in
lower case; lines under ``least_chars`` code points have none. Null and empty texts
are one empty line. Rows with a null id hold no lines (they don't count), but
lose the lines that enough documents hold. Repeated ids are one document; each
of its rows loses the same lines. Long texts are split whole. Other columns
are untouched; new names replace old ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import groups, own_names, stage

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLANKS = b" \t\n\x0b\x0c\r"
SLOTS = 4


def key_of(line: bytes, least_chars: int) -> bytes | None:
    """The key of a line of lower-cased UTF-8 bytes, or None for a short one."""
    s = line.strip(BLANKS)
    if len(s) < least_chars or not (s.isascii() or len(s.decode()) >= least_chars):
        return None
    return xxhash.xxh3_128_digest(s)


class Cuckoo:
    """A cuckoo filter over 64-bit hashes, filled in vectorised rounds. A key
    may be in any of eight slots; equal keys are to be inserted once."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.n = buckets  # a power of two
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @staticmethod
    def sized(keys: int) -> Cuckoo:
        return Cuckoo(1 << max(1, math.ceil(math.log2(max(1, keys) / SLOTS / 0.8))))

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = (h & np.uint64(self.n - 1)).astype(np.int64)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & (self.n - 1))

    def has(self, h: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(h)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(1)

    def insert(self, h: np.ndarray, rounds: int = 500) -> bool:
        """False if the filter is too full (then build a larger one)."""
        mark, one, two = self._places(h)
        rng = np.random.default_rng(1)
        bucket, second = one, two
        for _ in range(rounds):
            if not len(mark):
                return True
            mark, bucket, second = self._put(mark, bucket, second)
            if not len(mark):
                return True
            mark, bucket, second = self._put(mark, second, bucket)
            if not len(mark):
                return True
            # both buckets full: in the one tried first (for a displaced fingerprint
            # not the one that it came from) one of each bucket's makes room
            bucket, second = second, bucket
            _, lead = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(lead))
            out = self.table[bucket[lead], slot].copy()
            self.table[bucket[lead], slot] = mark[lead]
            mark = mark.copy()
            mark[lead] = out
            second = second.copy()
            second[lead] = bucket[lead]
            bucket = bucket.copy()
            bucket[lead] = self._other(second[lead], out)
        return not len(mark)

    def _put(self, mark, bucket, second):
        """Fill free slots; returns what found none."""
        order = np.argsort(bucket, kind="stable")
        mark, bucket, second = mark[order], bucket[order], second[order]
        rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
        free = self.table[bucket] == 0
        fits = rank < free.sum(1)
        slot = np.argmax(free.cumsum(1) == (rank + 1)[:, None], 1)
        self.table[bucket[fits], slot[fits]] = mark[fits]
        return mark[~fits], bucket[~fits], second[~fits]

    def delete(self, h: np.ndarray) -> None:
        """Take out keys that are in the filter, each one copy."""
        for m, a, b in zip(*self._places(h), strict=True):
            for bucket in (a, b):
                found = np.flatnonzero(self.table[bucket] == m)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break


def _hash(keys: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """64 bits of the keys."""
    return np.frombuffer(b"".join(k.as_py() for k in keys), "<u8").reshape(-1, 2)[:, 1].copy()


def lines_of(docs: DataFrame, least_chars: int = 40, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, key)``: the distinct keys of each row's lines."""

    def split(texts: pa.Array) -> pa.Array:
        keys = [list({k for x in (t.as_py() or "").encode().translate(_LOWER).split(b"\n") if (k := key_of(x, least_chars)) is not None}) for t in texts]
        return pa.array(keys, pa.list_(pa.binary()))

    found = docs.select(F.col(id_col).alias("doc_id"), F.arrow_udf(split, "array<binary>")(F.col(text).cast("string")).alias("keys"))
    return found.select("doc_id", F.explode("keys").alias("key"))


def _shard(shards: int):
    return F.pmod(F.xxhash64(F.lit("shard"), F.col("key")), F.lit(shards)).cast("int")


def build_filters(refs: DataFrame) -> DataFrame:
    """``(shard, filter)`` over ``refs(shard, key)`` with distinct keys."""

    def build(batches):
        for (shard,), t in groups(batches, ["shard"]):
            h = _hash(t["key"])
            f = Cuckoo.sized(len(h))
            while not f.insert(h):
                f = Cuckoo(2 * f.n)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f.table.tobytes()], pa.binary())], ["shard", "filter"])

    return refs.select("shard", "key").repartition("shard").sortWithinPartitions("shard").mapInArrow(build, "shard int, filter binary")


def pass_filters(rows: DataFrame, filters: DataFrame, salts: int = 16) -> DataFrame:
    """``rows(shard, key, ...)`` with ``seen``: false where the shard's filter
    surely doesn't have the key. A shard's rows stream past its filter in
    ``salts`` tasks, so one common key doesn't fill a task."""
    names = [c for c in rows.columns if c != "shard"]
    cell = F.pmod(F.xxhash64(F.lit("salt"), *names), F.lit(salts)).cast("int")
    right = rows.select("shard", cell.alias("salt"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("filter"), *names)
    left = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "filter", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in names])
    both = left.unionByName(right).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    out = rows.select("shard", *names).schema.add("seen", "boolean")

    def probe(batches):
        at, f = None, None
        for b in batches:
            cell = np.asarray(b["shard"]).astype(np.int64) * salts + np.asarray(b["salt"])
            kind = np.asarray(b["kind"])
            seen = np.zeros(b.num_rows, bool)
            cut = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), b.num_rows]
            for x, y in zip(cut, cut[1:], strict=False):
                if x == y:
                    continue
                if at != cell[x]:
                    at, f = cell[x], None
                while x < y and kind[x] == 0:
                    raw = b["filter"][x].as_py()
                    f = Cuckoo(len(raw) // 2 // SLOTS, np.frombuffer(raw, np.uint16).reshape(-1, SLOTS))
                    x += 1
                if f is not None and x < y:
                    seen[x:y] = f.has(_hash(b["key"].slice(x, y - x)))
            mine = pa.array(kind == 1)
            yield pa.RecordBatch.from_arrays([*(b[c].filter(mine) for c in ["shard", *names]), pa.array(seen[kind == 1])], ["shard", *names, "seen"])

    return both.mapInArrow(probe, out)


def change_filters(filters: DataFrame, removed: DataFrame, added: DataFrame, refs: DataFrame) -> DataFrame:
    """The filters with the keys of ``removed(shard, key)`` taken out and those
    of ``added(shard, key)`` put in. A shard that gets too full is built anew
    from ``refs``, the exact table as it is after the change."""
    none = F.lit(None).cast("binary")
    rows = (
        filters.select("shard", F.lit(0).alias("kind"), none.alias("key"), "filter")
        .unionByName(removed.select("shard", F.lit(1).alias("kind"), "key", none.alias("filter")))
        .unionByName(added.select("shard", F.lit(2).alias("kind"), "key", none.alias("filter")))
    )

    def change(batches):
        for (shard,), t in groups(batches, ["shard"]):
            kind = np.asarray(t["kind"].combine_chunks())
            keys = t["key"].combine_chunks()
            new = _hash(keys.filter(pa.array(kind == 2)))
            if (kind == 0).any():
                raw = t["filter"].combine_chunks().filter(pa.array(kind == 0))[0].as_py()
                f = Cuckoo(len(raw) // 2 // SLOTS, np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())
                f.delete(_hash(keys.filter(pa.array(kind == 1))))
            else:
                f = Cuckoo.sized(len(new))
            fits = f.insert(new)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f.table.tobytes() if fits else None], pa.binary())], ["shard", "filter"])

    got = stage(rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(change, "shard int, filter binary"), "filters")
    full = got.where("filter is null").select("shard")
    return got.where("filter is not null").unionByName(build_filters(refs.join(full, "shard", "left_semi")))


@dataclass(frozen=True)
class LineStore:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int

    @staticmethod
    def build(docs: DataFrame, shards: int, least_chars: int = 40, text: str = "text", id_col: str = "doc_id") -> LineStore:
        """A new store over ``docs``; its filters are built when first used."""
        found = lines_of(docs, least_chars, text, id_col).where("doc_id is not null")
        # distinct (key, doc_id) pairs also where an id repeats; a row's own keys are distinct already
        postings = stage(found.distinct(), "postings")
        refs = stage(_counts(postings, shards), "refs")
        return LineStore(postings, refs, build_filters(refs), shards)

    def insert(self, docs: DataFrame, least_chars: int = 40, text: str = "text", id_col: str = "doc_id") -> LineStore:
        """The store with further documents (known ids may come again)."""
        found = lines_of(docs, least_chars, text, id_col).where("doc_id is not null").distinct()
        asked = stage(pass_filters(found.withColumn("shard", _shard(self.shards)), self.filters), "asked")
        old = asked.where("seen").select("key", "doc_id").join(self.postings, ["key", "doc_id"], "left_anti")
        added = stage(asked.where("not seen").select("key", "doc_id").unionByName(old), "added")
        postings = stage(self.postings.select("key", "doc_id").unionByName(added), "postings")
        more = stage(_counts(added, self.shards), "more")
        refs = self.refs.unionByName(more).groupBy("shard", "key").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
        refs = stage(refs, "refs")
        new = more.select("shard", "key").join(self.refs.select("key"), "key", "left_anti").select("shard", "key")
        return LineStore(postings, refs, stage(change_filters(self.filters, new.limit(0), new, refs), "filters"), self.shards)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineStore:
        """The store without the documents of ``ids``. Only their keys are
        counted anew; those that nobody holds any more leave the filters."""
        gone = ids.select(F.col(id_col).alias("doc_id")).distinct()
        out = stage(self.postings.join(gone, "doc_id", "left_semi").select("key").distinct(), "out")
        postings = stage(self.postings.join(gone, "doc_id", "left_anti").select("key", "doc_id"), "postings")
        same = self.refs.join(out, "key", "left_anti").select("shard", "key", "n_docs", "last_doc")
        again = stage(_counts(postings.join(out, "key", "left_semi"), self.shards), "again")
        refs = stage(same.unionByName(again), "refs")
        lost = out.join(again.select("key"), "key", "left_anti").select(_shard(self.shards).alias("shard"), "key")
        return LineStore(postings, refs, stage(change_filters(self.filters, lost, lost.limit(0), refs), "filters"), self.shards)

    def droppable(self, least_docs: int = 5) -> DataFrame:
        """``(doc_id, keys)``: the lines a document loses; exact."""
        common = stage(self.refs.where(F.col("n_docs") >= least_docs), "common")
        asked = pass_filters(self.postings.select(_shard(self.shards).alias("shard"), "key", "doc_id"), build_filters(common))
        held = asked.where("seen").select("key", "doc_id").join(common.select("key", "last_doc"), "key").where("doc_id <> last_doc")
        return held.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))  # at most a document's own lines


def _counts(postings: DataFrame, shards: int) -> DataFrame:
    return postings.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")).select(_shard(shards).alias("shard"), "key", "n_docs", "last_doc")


@own_names
def drop_lines(docs: DataFrame, least_docs: int = 5, least_chars: int = 40, text: str = "text", id_col: str = "doc_id", shards: int | None = None) -> DataFrame:
    """``docs`` with ``text`` without the repeated lines, and ``n_lines``
    (before) and ``n_dropped``. A line that ``least_docs`` documents hold
    stays only in the one with the largest id."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    store = LineStore.build(docs, shards, least_chars, text, id_col)
    lost = stage(store.droppable(least_docs), "lost").withColumnRenamed("doc_id", "__id").withColumnRenamed("keys", "__keys")
    common = store.refs.where(F.col("n_docs") >= least_docs).select("key")

    def cut(texts: pa.Array, keys: pa.Array) -> pa.Array:
        out, total, dropped = [], [], []
        for t, k in zip(texts, keys, strict=True):
            whole, n = t.as_py() or "", 0
            lines = whole.split("\n")
            total.append(len(lines))
            if k.is_valid and len(k.values):
                gone = set(k.as_py())
                low = whole.encode().translate(_LOWER).split(b"\n")
                kept = [x for x, y in zip(lines, low, strict=True) if key_of(y, least_chars) not in gone]
                whole, n = "\n".join(kept), len(lines) - len(kept)
            out.append(whole)
            dropped.append(n)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())], ["kept", "n_lines", "n_dropped"])

    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    joined = docs.select(*keep).join(lost.hint("merge"), F.col(id_col) == F.col("__id"), "left")
    if docs.where(F.col(id_col).isNull()).limit(1).count():
        # rows without an id are compared with all common lines, one group of keys a row
        odd = docs.where(F.col(id_col).isNull()).select(*keep).withColumn("__n", F.monotonically_increasing_id())
        odd = stage(odd, "no-id")
        theirs = lines_of(odd, least_chars, text, "__n").join(common, "key", "left_semi").groupBy("doc_id").agg(F.collect_list("key").alias("__keys"))
        odd = odd.join(theirs.withColumnRenamed("doc_id", "__id"), F.col("__n") == F.col("__id"), "left").drop("__n")
        joined = joined.where(F.col(id_col).isNotNull()).unionByName(odd)
    got = joined.withColumn("__cut", F.arrow_udf(cut, "kept string, n_lines long, n_dropped long")(F.col(text).cast("string"), F.col("__keys")))
    return got.select(*[F.col("__cut.kept").alias(c) if c == text else F.col(c) for c in keep], "__cut.n_lines", "__cut.n_dropped")
