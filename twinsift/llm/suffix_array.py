"""Suffix-array dedup of passages: bytes covered by a string of ``window``
bytes that also starts in a document with a smaller id are removed.

The suffix array is built in linear time by grouping: suffixes start in
groups by their first byte; groups are taken in descending order, and
the previous smaller suffixes of a group's members (found along pointers) move
into groups of their own, by how many members point to them, until every
group holds the suffixes with one longest Lyndon prefix. The second phase
emits each group's order in one pass along the same pointers. No renaming
and no recursion take place.

How the work is dealt: every ``window`` bytes hold an anchor, the ``gram`` bytes
with the smallest hash, and equal windows have the same one. The windows of
one anchor occurrence are a piece of text (window bytes and a little more). Occurrences meet by
anchor; anchors that one document alone has end there. Equal pieces are one class with a
smallest id; if an anchor's pieces are all equal that settles them. Otherwise one
piece of each class goes, cut back to what it shares with another on either
side of the anchor, into the suffix arrays, where runs of suffixes with equal first
``window`` bytes give the smallest id for every window. The class's members
compare their ids with it. A class that is common within one task's texts travels
as one summary; its members go by themselves and are joined to the answer
later, so no task gathers a common passage's occurrences.

Null and empty texts have no bytes. Rows with a null id count as later than
all others. Rows that share an id are never earlier than each other. Very
long texts are read whole; runs of one repeated anchor are cut into
overlapping pieces. Other columns stay; new names replace old ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import buffers, fresh, groups, mix, own_names, stage

LATE = (1 << 63) - 1
RUN = 4096  # windows of a piece, at most
FLUSH = 1_000_000  # anchors that a task holds
COMMON = 128  # members of a class within a flush that travel apart


# --- the suffix array -------------------------------------------------------


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes of ``text`` in order, by Lyndon groups. The last symbol must
    be the only smallest one."""
    n = len(text)
    # groups are ranges of ``order``; a group is known by where it starts
    order = sorted(range(n), key=text.__getitem__)
    place, start, size = [0] * n, [0] * n, [0] * n
    at = 0
    for k, s in enumerate(order):
        if k and text[s] != text[order[k - 1]]:
            at = k
        place[s], start[s] = k, at
        size[at] += 1
    before = [-1] * n  # the previous suffix of a smaller group
    end = n - 1
    while end >= 0:
        first = start[order[end]]
        if first == end:  # a group of one
            s = order[end]
            p = s - 1
            while p >= 0 and start[p] >= first:
                p = before[p]
            before[s] = p
            if p >= 0:
                old = start[p]
                last = old + size[old] - 1
                if last > old:  # p leaves its group and comes right after it
                    k, other = place[p], order[last]
                    order[k], order[last] = other, p
                    place[other], place[p] = k, last
                    size[old] -= 1
                    start[p] = last
                    size[last] = 1
            end = first - 1
            continue
        times: dict[int, int] = {}
        for s in sorted(order[first : end + 1]):
            p = s - 1
            while p >= 0 and start[p] >= first:
                p = before[p]
            before[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        sets: dict[tuple[int, int], list[int]] = {}
        for p, c in times.items():
            sets.setdefault((-c, start[p]), []).append(p)
        for (_, old), members in sorted(sets.items()):  # most pointers first: they end up last
            last = old + size[old]
            for p in members:
                last -= 1
                k, other = place[p], order[last]
                order[k], order[last] = other, p
                place[other], place[p] = k, last
            size[old] -= len(members)
            size[last] = len(members)
            for p in members:
                start[p] = last
        end = first - 1
    # second phase: each suffix places the chain of those that it decides
    out, front, done = [-1] * n, list(range(n)), [False] * n
    out[0], done[n - 1] = n - 1, True
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = start[s]
            out[front[g]] = s
            front[g] += 1
            done[s] = True
            s = before[s]
    return out


def earliest(pieces: list[bytes], ids: list[int], window: int) -> list[np.ndarray]:
    """For every window of every piece the smallest id of a piece that has it."""
    sizes = np.array([len(p) for p in pieces])
    joined = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.int64) + 2
    ends = np.cumsum(sizes + 1) - 1
    joined[ends] = 1  # below all bytes
    joined[-1] = 0  # and below that
    order = np.array(suffix_array(joined.tolist()))
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    order = order[order < len(piece)]
    order = order[ends[piece[order]] - order >= window]  # whole windows only; those of equal suffixes stay adjacent
    best = np.full(len(joined), LATE)
    if len(order):
        views = np.lib.stride_tricks.sliding_window_view(joined.astype(np.int16), window)
        same = np.concatenate([[False], *[(views[order[a + 1 : a + 65537]] == views[order[a : min(a + 65536, len(order) - 1)]]).all(1) for a in range(0, len(order) - 1, 65536)]])
        run = np.flatnonzero(~same)
        least = np.minimum.reduceat(np.array(ids)[piece[order]], run)
        best[order] = np.repeat(least, np.diff(np.append(run, len(order))))
    starts = ends - sizes
    return [best[a : a + max(0, s - window + 1)] for a, s in zip(starts.tolist(), sizes.tolist(), strict=True)]


# --- anchors ----------------------------------------------------------------


def _grams(b: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams, by doubling."""
    cur, size, out, have = b.astype(np.uint64) + np.uint64(1), 1, None, 0
    power = np.array([0x100000001B3], np.uint64)
    left = k
    while left:
        if left & 1:
            if out is None:
                out, have = cur, size
            else:
                m = len(b) - have - size + 1
                out = out[:m] * power + cur[have : have + m]
                have += size
        left >>= 1
        if left:
            m = len(cur) - size
            cur = cur[:m] * power + cur[size : size + m]
            size *= 2
            power = power * power
    return mix(out)


def anchors(b: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows) of each run of windows that have
    one smallest gram hash; runs are cut after ``RUN`` windows."""
    wide = window - gram + 1
    if len(b) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, size = _grams(b, gram), 1
    while size * 2 <= wide:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < wide:
        low = np.minimum(low[: len(low) - (wide - size)], low[wide - size :])
    cut = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1, [len(low)]])
    first, n = cut[:-1], np.diff(cut)
    if (n > RUN).any():
        times = -(-n // RUN)
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        stop = np.repeat(first + n, times)
        first = np.repeat(first, times) + inner * RUN
        n = np.minimum(RUN, stop - first)
    return low[first], first, n


_PACK = "shard int, common boolean, key long, class long, doc binary, ord binary, at binary, n binary, keys binary, classes binary, least binary, most binary"


def _occurrences(window: int, gram: int, shards: int):
    """Documents -> packed occurrences: one row a shard and flush, and one for
    each common class."""
    names = [f.split()[0] for f in _PACK.split(", ")]

    def flush(held, turn):
        key, cls, doc, order, at, n = (np.concatenate(x) for x in zip(*held, strict=True))
        shard = (mix(key ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(shards)).astype(np.int64)
        # an anchor is known by its shard and 32 bits: two anchors that fall together are compared as
        # one, which costs time and changes nothing. Its classes keep all 64 bits: they alone say what is equal
        key = (shard.astype(np.uint64) << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))
        by = np.lexsort((cls, key))
        key, cls, doc, order, at, n, shard = (x[by] for x in (key, cls, doc, order, at, n, shard))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(key)))
        least, most = np.minimum.reduceat(order, first), np.maximum.reduceat(order, first)
        common = count >= COMMON
        rows = []
        single = np.repeat(~common, count)
        bounds = np.searchsorted(shard, np.arange(shards + 1))
        class_bounds = np.searchsorted(shard[first], np.arange(shards + 1))
        same = (doc == order).all()
        pack = lambda x, kind: np.ascontiguousarray(x).astype(kind).tobytes()
        for s in np.unique(shard).tolist():
            a, b = bounds[s], bounds[s + 1]
            pick = np.flatnonzero(single[a:b]) + a
            c = np.arange(class_bounds[s], class_bounds[s + 1])
            c = c[common[c]]
            lead = _where(order, first[c], count[c])
            head = pack(least[c], "<i8") + pack(key[lead], "<u8") + pack(cls[lead], "<u8") + pack(doc[lead], "<i8") + pack(at[lead], "<u4") + pack(n[lead], "<u2")
            rows.append((s, False, None, None, _ids_out(doc[pick]), b"" if same else _ids_out(order[pick]), pack(at[pick], "<u4"), pack(n[pick], "<u2"), pack(key[pick] & np.uint64(0xFFFFFFFF), "<u4"), pack(cls[pick], "<u8"), head, pack(most[c], "<i8")))
        for c in np.flatnonzero(common).tolist():
            x = slice(first[c], first[c] + count[c])
            spread = (int(key[first[c]]) + turn) % shards
            rows.append((spread, True, int(key[first[c]].view(np.int64)), int(cls[first[c]].view(np.int64)), _ids_out(doc[x]), b"" if same else _ids_out(order[x]), pack(at[x], "<u4"), pack(n[x], "<u2"), b"", b"", b"", b""))
        for a in range(0, len(rows), 512):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[a : a + 512], strict=True), [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 8], strict=True)], names)

    def run(batches):
        held, total, turn = [], 0, 0
        for batch in batches:
            raw, at = buffers(batch.column(2))
            docs, orders = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            whole = memoryview(raw)
            for i in range(batch.num_rows):
                b = raw[at[i] : at[i + 1]]
                key, first, n = anchors(b, window, gram)
                if not len(key):
                    continue
                base = int(at[i])
                digest = xxhash.xxh64_intdigest
                cls = np.array([digest(whole[x:y]) for x, y in zip((first + base).tolist(), (first + n + base + window - 1).tolist(), strict=True)], np.uint64)
                held.append((key, cls, np.full(len(key), docs[i]), np.full(len(key), orders[i]), first, n))
                total += len(key)
                if total >= FLUSH:
                    yield from flush(held, turn)
                    held, total, turn = [], 0, turn + 1
        if held:
            yield from flush(held, turn)

    return run


def _ids_out(x: np.ndarray) -> bytes:
    """Ids as their smallest and what each is above it, in four bytes where
    that fits and eight elsewhere."""
    if not len(x):
        return b""
    low = int(x.min())
    wide = int(x.max()) - low >= 1 << 32
    return np.array([low], "<i8").tobytes() + (x.astype("<i8") if wide else (x - low).astype("<u4")).tobytes()


def _ids_in(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    if len(b) == 8 + 8 * n:
        return np.frombuffer(b, "<i8", n, 8)
    return np.frombuffer(b, "<u4", n, 8).astype(np.int64) + np.frombuffer(b, "<i8", 1)[0]


def _where(order: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The row with the smallest order of each class."""
    return np.array([f + int(order[f : f + c].argmin()) for f, c in zip(first.tolist(), count.tolist(), strict=True)], np.int64)


#: kind 0: bytes to remove; 1: a class's piece to compare; 2: a member that waits for its class; 3: members of a common class; 4: a common class that is settled (all windows from ``ord``)
_OUT = "kind int, key long, class long, doc long, ord long, at long, n long, last long, members binary"


def _meet(window: int):
    """Packed occurrences of a shard -> what is settled and what to compare."""
    names = [f.split()[0] for f in _OUT.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 7, pa.binary()]

    def rows(kind, key, cls, doc, order, at, n, last=None):
        m = len(key)
        cols = [np.full(m, kind, np.int32), key.view(np.int64), cls.view(np.int64), doc, order, at.astype(np.int64), n.astype(np.int64), order if last is None else last]
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in cols), pa.nulls(m, pa.binary())], names)

    def run(batches):
        for (shard,), t in groups(batches, ["shard"]):
            parts, heads = [], []
            for r in t.to_pylist():
                at, n = np.frombuffer(r["at"], "<u4"), np.frombuffer(r["n"], "<u2")
                doc = _ids_in(r["doc"], len(n))
                order = _ids_in(r["ord"], len(n)) if r["ord"] else doc
                if r["common"]:
                    packed = doc.tobytes() + order.tobytes() + at.tobytes() + n.tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([3, r["key"], r["class"], None, None, None, len(doc), None, packed], kinds, strict=True)], names)
                    continue
                key = np.frombuffer(r["keys"], "<u4").astype(np.uint64) | np.uint64(shard << 32)
                cls = np.frombuffer(r["classes"], "<u8")
                parts.append((key, cls, doc, order, at, n))
                m = len(r["most"]) // 8
                if m:
                    x, f = r["least"], np.frombuffer
                    heads.append((f(x, "<u8", m, 8 * m), f(x, "<u8", m, 16 * m), f(x, "<i8", m, 24 * m), f(x, "<i8", m), f(x, "<u4", m, 32 * m), f(x, "<u2", m, 36 * m), f(r["most"], "<i8")))
            if not parts:
                continue
            key, cls, doc, order, at, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            most = order
            common = np.zeros(len(key), bool)
            if heads:  # a common class's summary stands in for its members
                h = [np.concatenate(x) for x in zip(*heads, strict=True)]
                key, cls, doc, order, at, n, most = (np.concatenate(x) for x in zip((key, cls, doc, order, at, n, most), h, strict=True))
                common = np.concatenate([common, np.ones(len(h[0]), bool)])
            by = np.lexsort((order, cls, key))
            key, cls, doc, order, at, n, most, common = (x[by] for x in (key, cls, doc, order, at, n, most, common))
            if not len(key):
                continue
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            new_class = new_key | np.concatenate([[True], cls[1:] != cls[:-1]])
            kf, cf = np.flatnonzero(new_key), np.flatnonzero(new_class)
            group, cgroup = np.cumsum(new_key) - 1, np.cumsum(new_class) - 1
            shared = np.minimum.reduceat(order, kf) != np.maximum.reduceat(most, kf)
            classes = np.bincount(group, new_class).astype(int)
            least = order[cf]  # sorted by order within the class
            one, many = shared & (classes == 1), shared & (classes > 1)
            pick = one[group] & ~common & (order > least[cgroup])
            yield rows(0, *(x[pick] for x in (key, cls, doc, order, at, n)))
            last = np.maximum.reduceat(most, cf)  # of the class
            pick = many[group[cf]]
            yield rows(1, *(x[cf[pick]] for x in (key, cls, doc, order, at, n)), last[pick])
            pick = many[group] & ~common
            yield rows(2, *(x[pick] for x in (key, cls, doc, order, at, n)))
            c = np.flatnonzero(common & one[group])
            if len(c):
                _, lead = np.unique(cgroup[c], return_index=True)
                c = c[lead]
                yield rows(4, key[c], cls[c], doc[c], least[cgroup[c]], at[c], n[c])

    return run


def _shared_ends(sides: list[bytes]) -> list[int]:
    """For each string how much of its start another one of the list has."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for x, y in zip(order, order[1:], strict=False):
        a, b = sides[x], sides[y]
        m = min(len(a), len(b))
        differ = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
        k = m - (differ.bit_length() + 7) // 8
        if k > out[x]:
            out[x] = k
        if k > out[y]:
            out[y] = k
    return out


def _cuts(texts: list[bytes], gram: int) -> list[tuple[int, int]]:
    """What of each piece another class can share: it reaches to both sides of
    the anchor as far as any other piece agrees. Pieces that don't have the
    anchor just once stay whole."""
    p = int(_grams(np.frombuffer(texts[0], np.uint8), gram).argmin())
    anchor = texts[0][p : p + gram]
    at = [t.find(anchor) for t in texts]
    if any(p < 0 or t.find(anchor, p + 1) >= 0 for t, p in zip(texts, at, strict=True)):
        return [(0, len(t)) for t in texts]
    left = _shared_ends([t[:p][::-1] for t, p in zip(texts, at, strict=True)])
    right = _shared_ends([t[p + gram :] for t, p in zip(texts, at, strict=True)])
    return [(p - a, p + gram + b) for p, a, b in zip(at, left, right, strict=True)]


def _compare(window: int, gram: int, most: int = 1 << 17):
    """Classes of an anchor (sorted by key) -> the windows that an earlier
    document has: (key, class, from, to, ord). Classes that are equal once
    they are cut back are one text; a text that is an anchor's only one is
    settled, the others go to suffix arrays of about ``most`` bytes."""
    names = ["key", "class", "lo", "hi", "ord"]

    def spans(key, cls, skip, best, own, last, n):
        cut = [0, *(np.flatnonzero(best[1:] != best[:-1]) + 1).tolist(), len(best)]
        found = [(key, cls, skip + a, skip + b, int(best[a])) for a, b in zip(cut, cut[1:], strict=False) if a < b and best[a] < last]
        if own < last:  # windows beside the shared part: the class's members have them alone
            found += [(key, cls, a, b, own) for a, b in ((0, skip), (skip + len(best), n)) if a < b]
        return found

    def answer(texts, ids, held):
        got = earliest(texts, ids, window)
        return [x for key, cls, skip, t, own, last, n in held for x in spans(key, cls, skip, got[t], own, last, n)]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)], names)

    def run(batches):
        texts, ids, held, total, out = [], [], [], 0, []
        for (key,), t in groups(batches, ["key"]):
            classes, orders, lasts, ns, pieces = (t[c].to_pylist() for c in ("class", "ord", "last", "n", "piece"))
            cuts = _cuts(pieces, gram) if max(ns) <= window - gram + 1 else [(0, len(p)) for p in pieces]
            own: dict[bytes, int] = {}  # text -> smallest id
            for p, (a, b), o in zip(pieces, cuts, orders, strict=True):
                if b - a >= window:
                    x = p[a:b]
                    own[x] = min(o, own.get(x, o))
            number = {}
            if len(own) > 1:
                for x, o in own.items():
                    number[x] = len(texts)
                    texts.append(x)
                    ids.append(o)
                    total += len(x) + 1
            for cls, o, last, n, p, (a, b) in zip(classes, orders, lasts, ns, pieces, cuts, strict=True):
                x = p[a:b]
                if x not in own:
                    out += spans(key, cls, 0, np.zeros(0, np.int64), o, last, n)
                elif x in number:
                    held.append((key, cls, a, number[x], o, last, n))
                else:
                    out += spans(key, cls, a, np.full(b - a - window + 1, own[x]), o, last, n)
            if total >= most:
                out += answer(texts, ids, held)
                texts, ids, held, total = [], [], [], 0
            if len(out) > 50_000:
                yield batch(out)
                out = []
        if texts:
            out += answer(texts, ids, held)
        if out:
            yield batch(out)

    return run


# --- the operator -----------------------------------------------------------


@own_names
def remove_repeats(docs: DataFrame, window: int = 50, gram: int = 20, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the bytes that stay in ``kept`` (binary: a cut can fall
    into a character), ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans``
    (array of [from, to) in bytes)."""
    spark = docs.sparkSession
    shards = max(64, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    new = ("kept", "n_bytes", "n_removed", "n_spans", "spans")
    base = docs.select(*[c for c in docs.columns if c.lower() not in new])
    odd = base.groupBy(id_col).count().where(F.col("count").cast("long") > F.when(F.col(id_col).isNull(), 0).otherwise(1)).limit(1).count()
    rid, order = fresh(base, "rid"), F.coalesce(F.col(id_col).cast("long"), F.lit(LATE))
    if odd:  # ids that repeat or lack: rows get numbers of their own, fixed in a written table
        base = stage(base.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    else:
        base = base.withColumn(rid, F.col(id_col).cast("long"))
    base = base.where(F.col(rid).isNotNull())
    source = base.select(F.col(rid).alias("doc"), order.alias("ord"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    packed = source.mapInArrow(_occurrences(window, gram, shards), _PACK)
    found = stage(packed.repartition("shard").sortWithinPartitions("shard").mapInArrow(_meet(window), _OUT), "anchors")

    span = lambda at, n: F.struct(at.alias("a"), (at + n + window - 1).alias("b"))
    marks = found.where("kind = 0").select("doc", span(F.col("at"), F.col("n")).alias("s"))
    # pieces of classes that differ
    ask = found.where("kind = 1").groupBy("key", "class").agg(F.min_by(F.struct("doc", "at", "n"), F.struct("ord", "doc")).alias("r"), F.min("ord").alias("ord"), F.max("last").alias("last"))
    ask = ask.select(F.col("r.doc").alias("__doc"), F.struct("key", "class", "ord", "last", F.col("r.at").alias("at"), F.col("r.n").alias("n")).alias("q")).groupBy("__doc").agg(F.collect_list("q").alias("q"))  # pieces of one document

    def extract(batches):
        for batch in batches:
            raw, at = buffers(batch.column(1))
            out = []
            for i, q in enumerate(batch.column(0)):
                for r in q.as_py():
                    a = int(at[i]) + r["at"]
                    out.append((r["key"], r["class"], r["ord"], r["last"], r["n"], raw[a : a + r["n"] + window - 1].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, [pa.int64()] * 5 + [pa.binary()], strict=True)], ["key", "class", "ord", "last", "n", "piece"])

    pieces = base.join(ask.hint("merge"), F.col(rid) == F.col("__doc")).select("q", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).mapInArrow(extract, "key long, class long, ord long, last long, n long, piece binary")
    answers = stage(pieces.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(window, gram), "key long, class long, lo long, hi long, ord long"), "windows")

    def unpack(packed: pa.Array, n: pa.Array) -> pa.Array:
        out = []
        for x, m in zip(packed, n.to_pylist(), strict=True):
            b, f = x.as_py(), np.frombuffer
            out.append([{"doc": d, "ord": o, "at": a, "n": k} for d, o, a, k in zip(f(b, "<i8", m).tolist(), f(b, "<i8", m, 8 * m).tolist(), f(b, "<u4", m, 16 * m).tolist(), f(b, "<u2", m, 20 * m).tolist(), strict=True)])
        return pa.array(out, pa.list_(pa.struct([("doc", pa.int64()), ("ord", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])))

    common = found.where("kind = 3").select("key", "class", F.explode(F.arrow_udf(unpack, "array<struct<doc:long,ord:long,at:long,n:long>>")("members", "n")).alias("m")).select("key", "class", "m.*")
    settled = found.where("kind = 4").groupBy("key", "class").agg(F.min("ord").alias("first"))
    marks = marks.unionByName(common.join(settled, ["key", "class"]).where("ord > first").select("doc", span(F.col("at"), F.col("n")).alias("s")))
    waiting = found.where("kind = 2").select("key", "class", "doc", "ord", "at").unionByName(common.select("key", "class", "doc", "ord", "at"))
    theirs = waiting.join(answers.withColumnRenamed("ord", "first"), ["key", "class"]).where("ord > first")
    marks = marks.unionByName(theirs.select("doc", span(F.col("at") + F.col("lo"), F.col("hi") - F.col("lo")).alias("s")))
    marks = marks.groupBy("doc").agg(F.collect_list("s").alias("s")).select(F.col("doc").alias("__doc"), F.col("s").alias("__s"))  # of one document

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        raw, at = buffers(texts)
        out = []
        for i, s in enumerate(spans):
            b = raw[at[i] : at[i + 1]]
            if s.is_valid and len(s.values):
                v = s.values
                edge = np.zeros(len(b) + 1, np.int64)
                np.add.at(edge, np.asarray(v.field("a")), 1)
                np.add.at(edge, np.asarray(v.field("b")), -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                out.append((b[~gone].tobytes(), len(b), int(gone.sum()), [{"from": x, "to": y} for x, y in turn.reshape(-1, 2).tolist()]))
            else:
                out.append((b.tobytes(), len(b), 0, []))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))]
        cols = list(zip(*out, strict=True)) or [[]] * 4
        return pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["kept", "n_bytes", "n_removed", "spans"])

    joined = base.join(marks.hint("merge"), F.col(rid) == F.col("__doc"), "left")
    done = joined.withColumn("__c", F.arrow_udf(cut, "struct<kept:binary,n_bytes:long,n_removed:long,spans:array<struct<from:long,to:long>>>")(F.coalesce(F.col(text).cast("string"), F.lit("")), F.col("__s")))
    keep = [c for c in base.columns if c != rid]
    return done.select(*keep, "__c.kept", "__c.n_bytes", "__c.n_removed", F.size("__c.spans").cast("long").alias("n_spans"), "__c.spans")
