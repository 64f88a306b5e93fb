"""Sequence packing as a cutting-stock problem solved by column generation.

Documents are tokenised; one longer than a sequence is cut into full
sequences and a rest. The lengths of all pieces, in units of ``unit`` tokens
rounded up, give a histogram of at most size / unit classes. Its linear
program (fewest sequences that cover the histogram, one column for each
pattern of piece lengths that fits) is solved on the driver: a knapsack
dynamic program prices new patterns until none improves the bound. The
patterns' counts are rounded down, the few pieces left are packed best fit
decreasing, and every pattern's places are given to ranked pieces by a join
on rank ranges.

What rounding the lengths leaves free at the end of sequences is filled from
a reserve: a share of the pieces (chosen by hash, its size taken from the
histogram) is kept out of the program and then cut as the gaps need. What is
left of the reserve makes full sequences, and its end is cut into sequences
of powers of two, so padding stays near zero.

The driver sees only the histogram, so its work does not grow with the data.

Null and empty texts have only the end id. Rows with a null id are packed
like others. Repeated rows are packed each. Very long texts are tokenised
whole and cut. Other columns are ignored; the result has fixed columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from twinsift.llm.common import stage

# --- tokens -----------------------------------------------------------------

#: Texts with these go to the tokenizer whole: Python splits or lower-cases some of them differently.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "\u03a3", "\u0130", "\u180e", "<|")
#: Words of these alone (ASCII signs, Latin letters) are cut here the way the vocabulary's file says: runs of
#: letters, single digits, its English endings, runs of other signs.
_SAFE = re.compile("[!-~\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f]+")
_PARTS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+")


def _signs() -> dict[int, str]:
    """The letters that a byte-level vocabulary writes bytes as: printable
    Latin-1 for itself, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}


class Words(dict):
    """White-space separated, lower-cased word, or part of one -> its ids as
    bytes. The vocabulary splits at white space first, so a text's ids are those
    of its words in turn, and a part is cut no further. The first ``most`` words
    and parts met (the frequent ones are among them) are remembered."""

    def __init__(self, path: str, dtype: str, most: int = 500_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model, self.signs = self.tok.model, _signs()
        self.dtype, self.most = dtype, most
        self.one = [x.tobytes() for x in np.arange(self.tok.get_vocab_size(), dtype=dtype)]

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def keep(self, word: str, ids: bytes) -> bytes:
        if len(self) < self.most:
            self[word] = ids
        return ids

    def part(self, part: str) -> bytes:
        got = self.get(part)
        if got is None:
            one = self.one
            shown = part if part.isascii() else "".join(map(self.signs.__getitem__, part.encode()))
            got = self.keep(part, b"".join([one[t.id] for t in self.model.tokenize(shown)]))
        return got

    def __missing__(self, word: str) -> bytes:
        if not _SAFE.fullmatch(word):
            return self.keep(word, self.whole(word))
        if word.isalpha():
            return self.part(word)
        return self.keep(word, b"".join(map(self.part, _PARTS.findall(word))))

    def ids(self, text: str) -> bytes:
        if any(s in text for s in _ODD):
            return self.whole(text)
        return b"".join(map(self.__getitem__, unicodedata.normalize("NFC", text).lower().split()))


_CACHE: dict = {}


def tokens(path: str, dtype: str, end: int):
    """Text -> ids (with the end id) as bytes; the vocabulary is loaded once a worker."""
    words = _CACHE.get((path, dtype))
    if words is None:
        words = _CACHE[(path, dtype)] = Words(path, dtype)
    tail = np.array([end], dtype).tobytes()
    return lambda text: words.ids(text) + tail


def pieces(docs: DataFrame, path: str, vocabulary: int, end: int = 2, size: int = 4096, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, doc_tokens, start, length, ids)``, cut at full sequences."""
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    width = np.dtype(dtype).itemsize
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, doc_tokens long, start long, length long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(path, dtype, end)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                at, total, start, length, ids = [], [], [], [], []
                for i, t in enumerate(part.column(1)):
                    raw = encode(t.as_py() or "")
                    n = len(raw) // width
                    for s in range(0, n, size):
                        at.append(i)
                        total.append(n)
                        start.append(s)
                        length.append(min(size, n - s))
                        ids.append(raw[s * width : (s + size) * width])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (total, start, length)), pa.array(ids, pa.binary())], [id_col, "doc_tokens", "start", "length", "ids"])

    got = docs.select(F.col(id_col), F.col(text).cast("string").alias("text")).mapInArrow(cut, schema)
    return got.withColumnRenamed(id_col, "doc_id")


# --- the program ------------------------------------------------------------


def best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """The knapsack dynamic program: counts of each size that fit into
    ``room`` with the largest total value."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fits = sizes <= r
        got = np.where(fits, value + best[np.maximum(r - sizes, 0)], -1.0)
        k = int(got.argmax())
        best[r], took[r] = (got[k], k) if got[k] > best[r - 1] + 1e-12 else (best[r - 1], -1)
    counts, r = np.zeros(len(sizes), np.int64), room
    while r > 0:
        if took[r] < 0:
            r -= 1
        else:
            counts[took[r]] += 1
            r -= sizes[took[r]]
    return counts


def patterns(histogram: dict[int, int], room: int, gap: float = 1e-4) -> list[tuple[dict[int, int], int]]:
    """Patterns ({class: pieces}, how often) that place the histogram exactly.
    Column generation with a dense basis of one row a class; it ends when the
    price of the best pattern shows the bound to be within ``gap``."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    need = np.array([histogram[int(s)] for s in sizes], float)
    m = len(sizes)
    columns = [np.where(np.arange(m) == i, room // sizes[i], 0) for i in range(m)]
    inverse = np.diag(1.0 / (room // sizes))
    x = inverse @ need
    while True:
        price = inverse.sum(0)  # every sequence costs one
        new = best_pattern(price, sizes, room)
        worth = float(price @ new)
        if worth <= 1 + 1e-9 or x.sum() - (price @ need) / worth <= gap * x.sum():
            break
        step = inverse @ new
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        x = np.maximum(x - theta * step, 0)
        x[out] = theta
        inverse[out] /= step[out]
        rest = step.copy()
        rest[out] = 0
        inverse -= np.outer(rest, inverse[out])
        columns[out] = new
    left, plan = need.astype(np.int64), []
    for column, share in sorted(zip(columns, x, strict=True), key=lambda c: -c[1]):
        held = column > 0
        times = int(min(np.floor(share + 1e-6), (left[held] // column[held]).min()))
        if times:
            plan.append(({int(s): int(c) for s, c in zip(sizes, column, strict=True) if c}, times))
            left -= times * column
    return plan + best_fit({int(s): int(n) for s, n in zip(sizes, left, strict=True) if n}, room)


def best_fit(left: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Fill sequence after sequence with the largest piece that still fits,
    as often as the same filling repeats."""
    left, plan = dict(left), []
    while left:
        free, take = room, {}
        for s in sorted(left, reverse=True):
            k = min(left[s], free // s)
            if k:
                take[s] = k
                free -= k * s
        times = min(left[s] // k for s, k in take.items())
        plan.append((take, times))
        for s, k in take.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
    return plan


# --- places -----------------------------------------------------------------


def _running(df: DataFrame, group: list, order: list[str], value, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over earlier rows of the group."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def pack(docs: DataFrame, path: str, vocabulary: int, end: int = 2, size: int = 4096, unit: int = 16, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row a piece: ``(doc_id, doc_tokens, start, length, ids, sequence_id,
    offset)``; ``ids`` are unsigned 32-bit little-endian."""
    spark = docs.sparkSession
    room = size // unit
    raw = pieces(docs, path, vocabulary, end, size, text, id_col)
    # the place in the written table numbers the pieces: (part, row)
    mid = F.monotonically_increasing_id()
    table = stage(raw.withColumn("part", F.shiftright(mid, 33).cast("int")).withColumn("row", mid.bitwiseAND(F.lit((1 << 33) - 1))), "pieces")
    narrow = table.select("part", "row", "length")
    units = F.ceil(F.col("length") / F.lit(unit)).cast("int")

    # the reserve: as many tokens as the gaps will need
    lengths = {r[0]: (r[1], r[2]) for r in narrow.groupBy(units).agg(F.count("*"), F.sum("length")).collect()}
    total = sum(t for _, t in lengths.values())
    gaps = sum(c * unit * n - t for c, (n, t) in lengths.items()) + size * min(len(lengths), 1 + total // size) / 4
    share = min(1.0, 1.25 * gaps / max(total + gaps, 1) + 1e-4)
    grain = 1 << 20
    spare = F.pmod(F.xxhash64(F.lit("reserve"), "part", "row"), F.lit(grain)) < int(share * grain)
    ranked = narrow.where(~spare).withColumn("class", units)

    # global ranks within a class: places before this part, and the place in it
    counts = ranked.groupBy("class", "part").agg(F.count("*").alias("n"))
    before = _running(counts, ["class"], ["part"], "n", "before").select("class", "part", "before")
    w = Window.partitionBy("class", "part").orderBy("row")
    ranked = ranked.withColumn("r", F.row_number().over(w) - 1).join(before, ["class", "part"]).withColumn("rank", F.col("r") + F.col("before"))

    plan = patterns({r[0]: r[1] for r in counts.groupBy("class").agg(F.sum("n")).collect()}, room)
    rows, used, base = [], {}, 0
    for take, times in plan:
        for c, k in take.items():
            lo = used.get(c, 0)
            rows.append((c, lo, lo + k * times, k, base))
            used[c] = lo + k * times
        base += times
    n_sequences = base
    ranges = spark.createDataFrame(rows, "class int, lo long, hi long, k long, base long")
    # at most (size / unit) patterns and as many leftovers, of (size / unit) classes each
    placed = ranked.join(F.broadcast(ranges), "class").where("rank >= lo and rank < hi")
    placed = placed.withColumn("sequence_id", F.expr("base + (rank - lo) div k"))
    placed = _running(placed.select("part", "row", "length", "class", "rank", "sequence_id"), ["sequence_id"], ["class", "rank"], "length", "offset")
    placed = stage(placed.select("part", "row", "length", "sequence_id", "offset"), "placed")

    # gaps at the sequences' ends on one line of free tokens
    block = 4096
    gap = placed.groupBy("sequence_id").agg(F.sum("length").alias("full")).where(F.col("full") < size).withColumn("free", F.lit(size) - F.col("full")).withColumn("b", F.expr(f"sequence_id div {block}"))
    gap = stage(gap, "gaps")
    sums = _running(gap.groupBy("b").agg(F.sum("free").alias("s")).withColumn("one", F.lit(1)), ["one"], ["b"], "s", "before").select("b", "before")
    holes = _running(gap, ["b"], ["sequence_id"], "free", "inner").join(sums, "b").select("sequence_id", F.col("full").alias("offset"), (F.col("inner") + F.col("before")).alias("lo"), "free")
    # the reserve on the same line
    kept = narrow.where(spare)
    kept_before = _running(kept.groupBy("part").agg(F.sum("length").alias("s")).withColumn("one", F.lit(1)), ["one"], ["part"], "s", "before").select("part", "before")
    kept = _running(kept, ["part"], ["row"], "length", "inner").join(kept_before, "part").select("part", "row", "length", (F.col("inner") + F.col("before")).alias("lo"))
    kept = stage(kept, "reserve")
    have = kept.agg(F.sum("length")).first()[0] or 0
    hole = gap.agg(F.sum("free")).first()[0] or 0
    # beyond the gaps: full sequences, then powers of two; ranges of the line, not rows of data
    rest = max(0, have - hole)
    full = rest // size
    tail, at, number = [], hole + full * size, n_sequences + full
    for bit in range(size.bit_length() - 1, -1, -1):
        if (rest - full * size) >> bit & 1:
            tail.append((number, 0, at, 1 << bit))
            at += 1 << bit
            number += 1
    holes = holes.unionByName(spark.range(full).select((F.col("id") + n_sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), (F.col("id") * size + hole).alias("lo"), F.lit(size).cast("long").alias("free")))
    holes = holes.unionByName(spark.createDataFrame(tail, "sequence_id long, offset long, lo long, free long"))
    cells = lambda lo, n: F.explode(F.sequence(F.expr(f"{lo} div {size}"), F.expr(f"({lo} + {n} - 1) div {size}")))
    left = kept.select("part", "row", F.col("lo").alias("a"), "length", cells("lo", "length").alias("cell"))
    right = holes.select("sequence_id", "offset", F.col("lo").alias("h"), "free", cells("lo", "free").alias("cell"))
    lo, hi = F.greatest("a", "h"), F.least(F.col("a") + F.col("length"), F.col("h") + F.col("free"))
    met = left.join(right, "cell").where((lo < hi) & (F.col("cell") == F.expr(f"greatest(a, h) div {size}")))
    cut = met.select("part", "row", (lo - F.col("a")).alias("skip"), (hi - lo).alias("length"), "sequence_id", (F.col("offset") + lo - F.col("h")).alias("offset"))
    places = placed.withColumn("skip", F.lit(0).cast("long")).unionByName(cut)

    width = 2 if vocabulary <= 1 << 16 else 4

    def take(ids: pa.Array, skip: pa.Array, n: pa.Array) -> pa.Array:
        out = []
        for x, s, k in zip(ids, np.asarray(skip).tolist(), np.asarray(n).tolist(), strict=True):
            out.append(np.frombuffer(x.as_buffer(), f"<u{width}", k, s * width).astype("<u4").tobytes())
        return pa.array(out, pa.binary())

    whole = table.withColumnRenamed("length", "__n").join(places.hint("merge"), ["part", "row"])
    return whole.select("doc_id", "doc_tokens", (F.col("start") + F.col("skip")).alias("start"), "length", F.arrow_udf(take, "binary")("ids", "skip", "length").alias("ids"), "sequence_id", "offset")
