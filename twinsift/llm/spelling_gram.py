"""Spelling variants: words one edit apart, found by blocked Gram matrices.

Words are counted over all texts (each task adds up its own first). Two words
one edit apart differ by at most two in the squared distance of their letter
counts: 1 for a letter more, 2 for another letter. Within a block of words of
a length and the next one, the distances come from one matrix product of the
letter counts (|x|^2 + |y|^2 - 2xy); pairs at most two apart are verified
letter by letter.

Blocks: one edit leaves one half of a word as it is, so words of a length
are blocked with those one letter longer by their first half and, apart from
that, by the half at the end. Both together hold every near pair; a pair
that agrees in both is counted in the first. Small blocks share a matrix (only
pairs of one block count); blocks of more than ``TILE`` words are dealt out as
pairs of tiles, so that no block meets in one task. A block gives one row a
word (how many near words, the most frequent of them), never its pairs.

A word's form is its most frequent near word, if that one occurs at least
``ratio`` times as often. Counts grow along forms by that factor, so chains of
forms are short and have an end, which pointer doubling finds.

Null and empty texts have no words. Repeated rows count each. Rows with a
null id take part like others (their id is written as nothing where the id
decides on noise). Ties go to the smaller word in code-point order. Long texts
and long words are taken whole. An empty table has no words. Other columns of
the input don't matter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import stage

TILE = 2048
#: Rows of small blocks that share a matrix.
SHARED = 512
#: Words that a task adds up before it hands them on.
HELD = 200_000
_SIDE = 1024
#: Bytes of words that are compared at once.
_AT_ONCE = 1 << 22


# --- words ------------------------------------------------------------------


def count_words(docs: DataFrame, least_letters: int = 5, noise: int | None = 97, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(word, n)``: runs of Latin letters, A-Z lower-cased. Where the
    unsigned crc32 h of ``<id>:<run>`` is divisible by ``noise``, the run loses
    its letter h mod length (None: never)."""

    # letters are single bytes of Latin-1; anything beyond becomes "?", which is no letter
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least_letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in batches:
            for i, t in zip(b.column(0), b.column(1), strict=True):
                if not t.is_valid:
                    continue
                found = Counter(runs.findall(t.as_py().encode("latin-1", "replace").lower()))
                before = zlib.crc32(f"{i.as_py() if i.is_valid else ''}:".encode())
                for w, n in found.items():
                    if noise:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), before)
                        if h % noise == 0:
                            if len(w) <= least_letters:
                                continue
                            k = h % len(w)
                            w = w[:k] + w[k + 1 :]
                    held[w] = held.get(w, 0) + n
                if len(held) >= HELD:
                    yield hand_on()
        if held:
            yield hand_on()

    parts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


# --- near pairs -------------------------------------------------------------


def blocks(words: DataFrame) -> DataFrame:
    """``words(word, n)`` -> a row for each block of each word: ``short`` (the
    smaller of the block's two lengths), ``side`` (0 first half, 1 end) and
    ``key`` (a hash of that half), with the tiles of big blocks dealt out as
    ``i`` <= ``j``; ``t`` is the word's own tile."""
    n = F.length("word")
    roles = words.withColumn("short", F.explode(F.array(n, n - 1))).withColumn("own", F.length("word") == F.col("short"))
    first = F.expr("substring(word, 1, short div 2)")
    end = F.expr("right(word, short - short div 2)")
    keyed = roles.withColumn("half", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.xxhash64(first).alias("key")), F.struct(F.lit(1).alias("side"), F.xxhash64(end).alias("key"))))).select("word", "n", "short", "own", "half.*")
    by = ["short", "side", "key"]
    # a block compares words of its smaller length with each other and the rest
    sizes = keyed.groupBy(*by).agg(F.count("*").alias("size"), F.max("own").alias("any")).where("size > 1 and any")
    big = stage(sizes.where(F.col("size") > TILE).select(*by, F.ceil(F.col("size") / TILE).cast("int").alias("tiles")), "big-blocks")
    dealt = keyed.join(sizes.select(*by), by).join(big, by, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("t", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    return dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("word", "n", *by, "t", F.least("t", "o").cast("int").alias("i"), F.greatest("t", "o").cast("int").alias("j"))


def letter_counts(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Letter counts of words laid out in ``flat`` (26 letters, 64 beyond ASCII)."""
    letter = np.where(flat < 0x80, flat - 97, flat.astype(np.int64) - 0xC0 + 26)
    row = np.repeat(np.arange(len(size)), size)
    return np.bincount(row * 90 + letter, minlength=90 * len(size)).reshape(-1, 90).astype(np.float32)


def one_edit(flat: np.ndarray, start: np.ndarray, size: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of words (p not longer than q, by at most one letter): whether
    one edit parts them, the letters shared at the start, and at the end."""
    shortest = size[p]
    ok, lead, tail = np.zeros(len(p), bool), np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    for n in np.unique(shortest).tolist():
        of = np.flatnonzero(shortest == n)
        for a in range(0, len(of), max(1, _AT_ONCE // n)):
            k = of[a : a + max(1, _AT_ONCE // n)]
            place = np.arange(n)
            x, y = flat[start[p[k]][:, None] + place], flat[start[q[k]][:, None] + place]
            z = flat[(start[q[k]] + size[q[k]] - n)[:, None] + place]
            first, last = x != y, (x != z)[:, ::-1]
            lead[k] = np.where(first.any(1), first.argmax(1), n)
            tail[k] = np.where(last.any(1), last.argmax(1), n)
            same = size[q[k]] == n
            ok[k] = np.where(same, (lead[k] < n) & (lead[k] + tail[k] == n - 1), lead[k] + tail[k] >= n)
    return ok, lead, tail


def near_words(words: list[bytes], n: np.ndarray, short: np.ndarray, side: np.ndarray, group: np.ndarray, own: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of blocks -> (row, how many near words, the row of the best of
    them), for rows that have any. ``split`` marks rows of two different
    tiles: only pairs across them count."""
    size = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(size) - size
    x = letter_counts(flat, size)
    square = (x * x).sum(1)
    found_p, found_q = [], []
    for a in range(0, len(words), _SIDE):
        for b in range(a, len(words), _SIDE):
            if group[b] > group[min(a + _SIDE, len(words)) - 1]:
                break
            d = square[a : a + _SIDE, None] + square[None, b : b + _SIDE] - 2 * (x[a : a + _SIDE] @ x[b : b + _SIDE].T)
            p, q = np.nonzero(d <= 2)
            p, q = p + a, q + b
            keep = (p < q) & (group[p] == group[q])
            p, q = p[keep], q[keep]
            keep = ((size[p] == short[p]) | (size[q] == short[q])) & (~split[p] | (own[p] != own[q]))
            found_p.append(p[keep])
            found_q.append(q[keep])
    p, q = np.concatenate(found_p), np.concatenate(found_q)
    p, q = np.where(size[p] <= size[q], p, q), np.where(size[p] <= size[q], q, p)
    ok, lead, tail = one_edit(flat, start, size, p, q)
    half = short[p] // 2
    # the first half decides where it is equal; the end only where it is not
    ok &= np.where(side[p] == 0, lead >= half, (lead < half) & (tail >= short[p] - half))
    p, q = p[ok], q[ok]
    here, there = np.concatenate([p, q]), np.concatenate([q, p])
    alphabetic = np.empty(len(words), np.int64)
    alphabetic[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((alphabetic[there], -n[there], here))
    rows, at, many = np.unique(here[order], return_index=True, return_counts=True)
    return rows, many, there[order][at]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ("short", "side", "key", "i", "j")

    def run(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        col = {k: t.column(k).to_numpy() for k in (*keys, "n", "t")}
        new = np.concatenate([[False], np.logical_or.reduce([col[k][1:] != col[k][:-1] for k in keys])])
        words = [w.encode("latin-1") for w in t.column("word").to_pylist()]
        rows, many, best = near_words(words, col["n"], col["short"].astype(np.int64), col["side"], np.cumsum(new), col["t"], col["i"] != col["j"])
        word = t.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays([word.take(pa.array(rows)), pa.array(many, pa.int64()), pa.array(col["n"][best], pa.int64()), word.take(pa.array(best))], ["word", "n_near", "best_n", "best"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < SHARED:
            continue
        t = pa.Table.from_batches(held)
        cols = [t.column(k).to_numpy() for k in keys]
        starts = np.concatenate([[0], np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1])
        a = 0
        for b in starts.tolist():  # whole blocks only; the last may go on in the next batch
            if b - a >= SHARED or b == starts[-1]:
                if b > a:
                    yield run(t.slice(a, b - a))
                a = b
        held = t.slice(a).to_batches()
        rows = t.num_rows - a
    if held:
        yield run(pa.Table.from_batches(held))


def near(words: DataFrame) -> DataFrame:
    """``words(word, n)`` (distinct) -> ``(word, n_near, best_n, best)`` of the
    words that have near ones."""
    parts = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = ["short", "side", "key", "i", "j"]
    dealt = blocks(words).repartition(parts, *by).sortWithinPartitions(*by)
    found = dealt.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


# --- forms ------------------------------------------------------------------


def follow(links: DataFrame, steps: int) -> DataFrame:
    """``links(word, form)`` (one a word, no cycles, chains of at most
    ``steps``) -> ``(word, root)``, by pointer doubling. Words whose form has
    none itself are done after the first round and drop out."""
    links = stage(links, "forms")
    ended: DataFrame | None = None
    live = links.withColumnRenamed("form", "root")
    for _ in range(max(1, math.ceil(math.log2(max(2, steps)))) + 1):
        on = live.select(F.col("word").alias("at"), F.col("root").alias("next")) if ended is None else live.unionByName(ended).select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = stage(live.join(on, live.root == on.at, "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "forms")
        closed = step.where("not open").drop("open")
        ended = closed if ended is None else ended.unionByName(closed)
        live = step.where("open").drop("open")
    return ended.unionByName(live)


def group_spellings(docs: DataFrame, least_letters: int = 5, least: int = 3, ratio: int = 2, noise: int | None = None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of at least
    ``least_letters`` letters that occur ``least`` times."""
    words = stage(count_words(docs, least_letters, noise, text, id_col).where(F.col("n") >= least), "words")
    most = words.agg(F.max("n")).first()[0] or 1
    got = words.join(near(words), "word", "left")
    formed = F.col("best_n") >= ratio * F.col("n")
    told = stage(got.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "near-words")
    roots = follow(told.where("form is not null").select("word", "form"), max(1, math.ceil(math.log(most, ratio))))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
