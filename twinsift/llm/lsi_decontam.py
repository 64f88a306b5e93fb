"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents give the weights.
2. A randomised SVD of TF-IDF passages (all benchmark items and all passages
   of all documents) gives a latent basis, each direction divided by its
   singular value. The passage matrix stays distributed: tasks
   multiply their rows with a basis of fixed size and hand back their share of
   the product, which Spark adds up.
3. Every text is read as overlapping windows, of lengths near those of the
   items (classes that grow by 1.6; a window begins every eighth word, or every
   quarter of its length, and every word for very short items). A window and an item of its class
   whose latent cosine reaches ``floor`` are a candidate; nothing else is.
4. Candidates are verified by the longest common subsequence of words: a
   document is contaminated if a stretch of n + n / 4 + 28 words around the
   window has ``least`` of an item's n words in order, or ``paraphrase`` of them
   and the item's answer (its last sentence) as it is. Stretches that can't are
   passed over first: those without enough of the item's rarest words, or of
   all its words in any order.

``exact=True`` verifies all stretches that this bound leaves, whatever their
cosine. It loses none, so it is what the recall of the search is measured
against.

Words are runs of letters and digits, lower-cased. Null and empty texts are
clean; items without an id or words are left out; with no item every document
is clean. Items with one id (repeated rows) are one name; ties are all kept.
Very short items are found by the same steps. Texts are read whole. Items are taken in blocks
of ``block``, so what is sent to tasks is bounded at any number of items. All
columns of the documents stay; the new names replace old ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import added_up, buffers, slices, stage, word_hashes

BUCKETS = 1 << 16
#: Places of the matrix that are multiplied at once.
TOGETHER = 1 << 14
#: Groups of up to 2 ** FEW places are added up place by place.
FEW = 3
#: Bytes of words: ASCII letters and digits, everything beyond ASCII.
_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in range(256)])


def words_of(texts: pa.Array):
    """Runs of texts as (first text, word hashes, where each text's words
    begin), lower-cased."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, whole = buffers(texts)
    for i, j in slices(whole, 1 << 20):  # only so much is lower-cased at once
        raw, at = buffers(pc.utf8_lower(texts.slice(i, j - i).cast(pa.large_string())))
        base = int(at[0])
        b = raw[base : int(at[-1])]
        first, _, h = word_hashes(b, _WORD[b], at[:-1] - base)
        yield i, h, np.searchsorted(first, at - base)


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """(documents, in how many of them each of the 65,536 buckets occurs)."""

    def count(batches):
        n, total = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, h, at in words_of(batch.column(0)):
                n += len(at) - 1
                doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
                key = np.sort(doc * BUCKETS + bucket_of(h))  # a sort takes less than the hash table of np.unique
                total += np.bincount(key[np.diff(key, prepend=-1) > 0] % BUCKETS, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some], pa.int32()), pa.array([n, *total[some]], pa.int64())], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:
        out[r[0]] = r[1]
    return int(out[-1]), out[:-1]


def passages(texts: DataFrame, idf: np.ndarray, size: int = 64) -> DataFrame:
    """``(at, idx, val)``: TF-IDF rows of consecutive passages of ``size``
    words, many to a row: where each passage ends, its buckets and weights."""

    def cut(batches):
        for batch in batches:
            for _, h, at in words_of(batch.column(0)):
                many = -(-np.diff(at) // size)  # passages of each text
                if not many.sum():
                    continue
                text = np.repeat(np.arange(len(many)), np.diff(at))
                number = (np.cumsum(many) - many)[text] + (np.arange(len(h)) - at[text]) // size
                key, n = np.unique(number * BUCKETS + bucket_of(h), return_counts=True)
                k, of = key % BUCKETS, key // BUCKETS
                v = n * idf[k]
                first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                v /= np.maximum(np.sqrt(np.add.reduceat(v * v, first)), 1e-9)[of]
                arrays = [np.append(first[1:], len(k)).astype("<i4"), k.astype("<u2"), v.astype("<f4")]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], ["at", "idx", "val"])

    return texts.mapInArrow(cut, "at binary, idx binary, val binary")


def _sums(table: np.ndarray, at: np.ndarray, weight: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each group (``many`` places from ``first`` on) the weighted sum of
    the rows ``at`` its places; groups of about the same size are multiplied
    together."""
    out = np.empty((len(first), table.shape[1]), np.float32)
    size = np.ceil(np.log2(many)).astype(np.int64)
    for c in np.unique(size).tolist():
        group = np.flatnonzero(size == c)
        step, reach = max(1, TOGETHER >> c), np.arange(1 << c)
        for g in (group[s : s + step] for s in range(0, len(group), step)):
            there = reach < many[g][:, None]
            place = np.where(there, first[g][:, None] + reach, 0)
            share, rows = weight[place] * there, at[place]
            if c <= FEW:  # a product for each group would take longer than its numbers
                total = table.take(rows[:, 0], axis=0) * share[:, :1]
                for j in range(1, 1 << c):
                    total += table.take(rows[:, j], axis=0) * share[:, j : j + 1]
                out[g] = total
            else:
                out[g] = np.matmul(share[:, None, :], table.take(rows, axis=0))[:, 0]
    return out


def _together(batches, least: int = 1 << 19):
    """(places of each passage, their buckets, their weights), of as many rows
    of the matrix as have ``least`` places: a bucket's places are added up
    before the sum goes to its far-off row."""
    held, n = [], 0
    for batch in batches:
        for a, i, v in zip(*batch.columns, strict=True):
            held.append((np.diff(np.frombuffer(a.as_buffer(), "<i4").astype(np.int64), prepend=0), np.frombuffer(i.as_buffer(), "<u2"), np.frombuffer(v.as_buffer(), "<f4")))
            n += len(held[-1][1])
            if n >= least:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _product(matrix: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'(A basis): tasks multiply their rows, Spark adds up the shares; what
    comes back has the basis's size."""

    def share(batches):
        total = np.zeros(basis.shape, np.float32)
        for many, k, x in _together(batches):
            seen = _sums(basis, k, x, np.cumsum(many) - many, many)
            by = np.argsort(k, kind="stable")
            part = k[by]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            total[part[first]] += _sums(seen, np.repeat(np.arange(len(many)), many)[by], x[by], first, np.diff(np.append(first, len(part))))
        return total

    return added_up(matrix, share, basis.shape, "<f4")


def _orthonormal(q: np.ndarray) -> np.ndarray:
    """Columns of the same span, at right angles: twice by the Cholesky factor
    of the small Gram matrix, so no second matrix of that height is made but
    the result."""
    for _ in range(2):
        gram = sum(part.T.astype(np.float64) @ part for part in np.array_split(q, 16))
        width, turn = np.linalg.eigh(gram)
        q = q @ (turn / np.sqrt(np.maximum(width, 1e-12 * max(width[-1], 1e-30)))).astype(np.float32)
    return q


def latent_basis(matrix: DataFrame, rank: int = 32, extra: int = 8, rounds: int = 2, seed: int = 5) -> np.ndarray:
    """Randomised SVD: the leading right singular directions of the passage
    matrix, each divided by its singular value (buckets x rank)."""
    q = _orthonormal(np.random.default_rng(seed).standard_normal((BUCKETS, rank + extra), np.float32))
    for _ in range(rounds):
        q = _orthonormal(_product(matrix, q))
    small = (q.T @ _product(matrix, q)).astype(np.float64)  # (A q)'(A q)
    square, turn = np.linalg.eigh((small + small.T) / 2)
    square, turn = square[::-1][:rank], turn[:, ::-1][:, :rank]
    # directions that the passages don't have say nothing
    scale = np.where(square > 1e-6 * max(square[0], 1e-30), 1 / np.sqrt(np.maximum(square, 1e-30)), 0.0)
    return np.ascontiguousarray(q @ (turn * scale).astype(np.float32))


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit for each of a's words."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        if (of := where.get(w)) is not None:
            hit = row & of
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def has_run(run: np.ndarray, b: np.ndarray) -> bool:
    if not len(run) or len(run) > len(b):
        return False
    at = np.flatnonzero(b[: len(b) - len(run) + 1] == run[0])
    return any((b[i : i + len(run)] == run).all() for i in at.tolist())


def _unit(x: np.ndarray) -> np.ndarray:
    return x / max(float(np.linalg.norm(x)), 1e-9)


class Items:
    """Benchmark items, ready for the search: word hashes, answers, latent
    vectors by length, and postings of their rarest words. ``floor`` is the
    least cosine of a candidate; None stands for the exact bound."""

    SLACK = 28  # words that a stretch may have beside the item's and a quarter
    COARSE = 16  # starts that are tested together first
    STEP = 8  # words from a window to the next
    SHORT = 12  # items of fewer words have windows of their own length, from every word
    TOGETHER = 4096  # steps that are looked at at once

    def __init__(self, rows: list[tuple[int, str]], weight: np.ndarray, df: np.ndarray, least: float, paraphrase: float, floor: float | None = None):
        self.ids, self.words, self.answers = [], [], []
        for item, text in rows:
            _, h, _ = next(words_of(pa.array([text], pa.string())))
            if not len(h):
                continue
            end = [s for s in text.replace("\n", " ").replace("?", ".").replace("!", ".").split(".") if any(c.isalnum() for c in s)]
            _, tail, _ = next(words_of(pa.array([end[-1] if end else ""], pa.string())))
            self.ids.append(int(item))
            self.words.append(h)
            self.answers.append(tail if 3 <= len(tail) < len(h) else tail[:0])
        self.weight, self.least, self.paraphrase = weight, least, paraphrase
        self.sets = [np.unique(h) for h in self.words]
        self.latent = np.array([_unit(weight[bucket_of(h)].sum(0)) for h in self.words], np.float32).reshape(len(self.words), weight.shape[1])
        n = np.array([len(h) for h in self.words], np.int64)
        self.floor = floor
        self.length = np.where(n < self.SHORT, n, self._classes(n))
        self.reach = n + n // 4 + self.SLACK
        share = np.array([min(least, paraphrase) if len(a) else least for a in self.answers])
        self.need = np.maximum(1, np.ceil(share * n - 1e-9)).astype(np.int64)
        # of any n - need + g places of an item at least g are among need matched ones: the rarest tell most
        self.g = np.maximum(1, self.need // 6)
        pairs = []
        for k, h in enumerate(self.words):
            rare = h[np.argsort(df[bucket_of(h)], kind="stable")[: n[k] - self.need[k] + self.g[k]]]
            pairs += [(w, k) for w in set(rare.tolist())]
        pairs.sort()
        self.vocab, self.head = np.unique(np.array([w for w, _ in pairs], np.uint64), return_index=True)
        self.head = np.append(self.head, len(pairs))
        self.known = np.zeros(BUCKETS, bool)  # buckets with a word of the postings
        self.known[bucket_of(self.vocab)] = True
        self.post = np.array([k for _, k in pairs], np.int64)

    def _classes(self, n: np.ndarray) -> np.ndarray:
        """The window length (a multiple of STEP, each about 1.6 times the one
        before) nearest to each item's length."""
        lengths = [self.STEP]
        while lengths[-1] < n.max(initial=1):
            lengths.append(max(lengths[-1] + self.STEP, round(lengths[-1] * 1.6 / self.STEP) * self.STEP))
        c = np.array(lengths, np.int64)
        return c[np.abs(np.log(n[:, None] / c[None, :])).argmin(1)]

    def near(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Candidates of the latent search in texts h[at[i]:at[i + 1]]: (text,
        item position, and the first and last word that a stretch around the
        window can begin with); windows next to each other are one."""
        found = []
        bucket = bucket_of(h)
        for step, chosen in ((1, self.length < self.SHORT), (self.STEP, self.length >= self.SHORT)):
            if not chosen.any():
                continue
            # steps of the texts: sums of their words' vectors, from which all windows are made
            steps = -(-np.diff(at) // step)
            of = np.repeat(np.arange(len(steps)), steps)
            ends = np.cumsum(steps)
            begin = at[of] + (np.arange(len(of)) - (ends - steps)[of]) * step
            classes = [(int(w), np.flatnonzero(chosen & (self.length == w))) for w in np.unique(self.length[chosen])]
            reach = max(w // step for w, _ in classes)
            for a in range(0, len(begin), self.TOGETHER):
                z = min(a + self.TOGETHER, len(begin))
                more = min(z + reach, len(begin))  # windows go on beyond the last start
                run = np.zeros((more - a + 1, self.weight.shape[1]), np.float32)
                one = np.empty((more - a, self.weight.shape[1]), self.weight.dtype)
                stops = at[of[a:more] + 1]
                for k in range(step):  # a step's words, or those that its text still has
                    word = begin[a:more] + k
                    np.take(self.weight, bucket[np.minimum(word, len(bucket) - 1)], axis=0, out=one, mode="clip")
                    one[word >= stops] = 0
                    run[1:] += one
                np.cumsum(run, axis=0, out=run)
                for width, items in classes:
                    every = max(1, width // (4 * self.STEP)) if step > 1 else 1
                    start = np.arange(a, z)
                    if every > 1:
                        start = start[(start - (ends - steps)[of[start]]) % every == 0]
                    stop = np.minimum(start + width // step, ends[of[start]])
                    x = run[stop - a] - run[start - a]
                    size = np.sqrt(np.einsum("ij,ij->i", x, x))
                    like = self.latent[items] @ x.T >= np.maximum(self.floor * size, 1e-12)[None, :]
                    k, w = np.divmod(np.flatnonzero(like), len(start))
                    if not len(w):
                        continue
                    k, w = items[k], start[w]
                    first = np.maximum(begin[w] + width - self.reach[k], at[of[w]])
                    last = np.minimum(begin[w] + width, at[of[w] + 1]) - 1
                    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (of[w[1:]] != of[w[:-1]]) | (first[1:] > last[:-1] + 1)]))
                    found.append((of[w[new]], k[new], first[new], last[np.append(new[1:], len(w)) - 1]))
        if not found:
            return (np.zeros(0, np.int64),) * 4
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def around(self, h: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The ``regions`` that a candidate of the latent search lies in."""
        text, item, start, stop = self.near(h, at)
        bounds = self.regions(h, at) if len(text) else []
        if not bounds:
            return []
        # as intervals without overlap
        key = text * len(self.words) + item
        by = np.lexsort((start, key))
        key, start, stop = key[by], start[by], stop[by]
        top = np.maximum.accumulate(key * (len(h) + 1) + stop) - key * (len(h) + 1)  # the farthest stop so far
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] > top[:-1] + 1)]))
        key, start, stop = key[new], start[new], np.maximum.reduceat(stop, new)
        t, k, lo, hi = np.array(bounds, np.int64).T
        own = t * len(self.words) + k
        # the last interval of that text and item that begins before the region's end
        p = np.searchsorted(key * (len(h) + 1) + start, own * (len(h) + 1) + hi, "right") - 1
        met = (p >= 0) & (key[np.maximum(p, 0)] == own) & (stop[np.maximum(p, 0)] >= lo)
        return [x for x, yes in zip(bounds, met.tolist(), strict=True) if yes]

    def regions(self, h: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item position, first start, last start) of all stretches that
        can have enough of an item's words: those with enough of its rarest."""
        place = np.flatnonzero(self.known[bucket_of(h)])
        x = np.minimum(np.searchsorted(self.vocab, h[place]), len(self.vocab) - 1)
        same = self.vocab[x] == h[place]
        place, x = place[same], x[same]
        times = self.head[x + 1] - self.head[x]
        place = np.repeat(place, times)
        item = self.post[np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.head[x], times)]
        text = np.searchsorted(at, place, "right") - 1
        key = text * len(self.words) + item
        by = np.argsort(key, kind="stable")  # by text, item and place
        key, place, item, text = key[by], place[by], item[by], text[by]
        last = np.arange(len(key)) + self.g[item] - 1
        whole = np.minimum(last, len(key) - 1)
        ok = (last < len(key)) & (key[whole] == key) & (place[whole] - place < self.reach[item])
        key, item, text, stop, start = key[ok], item[ok], text[ok], place[ok], place[whole[ok]]
        start = np.maximum(start - self.reach[item] + 1, at[text])
        if not len(key):
            return []
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] > stop[:-1] + 1)])
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(key)) - 1
        return list(zip(text[first].tolist(), item[first].tolist(), start[first].tolist(), stop[end].tolist(), strict=True))

    def found(self, h: np.ndarray, at: np.ndarray) -> list[dict[int, float]]:
        """For each text (words h[at[i]:at[i + 1]]): item position -> latent
        cosine of the place that was tried first, for the items that it has."""
        out: list[dict[int, float]] = [{} for _ in range(len(at) - 1)]
        if not len(h) or not len(self.words):
            return out
        tries: dict[tuple[int, int], list[tuple[float, list[int]]]] = {}
        for t, k, lo, hi in self.regions(h, at) if self.floor is None else self.around(h, at):
            reach, end = int(self.reach[k]), int(at[t + 1])
            part = h[lo : min(hi + reach, end)]
            mine = self.sets[k]
            inside = mine[np.minimum(np.searchsorted(mine, part), len(mine) - 1)] == part
            tally = np.concatenate([[0], np.cumsum(inside)])
            starts = np.flatnonzero(inside[: hi - lo + 1])  # the item's words bound the common subsequence
            count = tally[np.minimum(starts + reach, len(part))] - tally[starts]
            enough = count >= self.need[k]
            if enough.any():
                best = lo + int(starts[count.argmax()])
                v = self.weight[bucket_of(h[best : min(best + reach, end)])].sum(0)
                tries.setdefault((t, k), []).append((float(_unit(v) @ self.latent[k]), (lo + starts[enough]).tolist()))
        for (t, k), places in tries.items():
            places.sort(reverse=True)  # the nearest first, all of them until one passes
            if any(self._verify(k, h, starts, int(at[t + 1])) for _, starts in places):
                out[t][k] = places[0][0]
        return out

    def _enough(self, k: int, part: np.ndarray) -> bool:
        share = common_words(self.words[k], part) / len(self.words[k])
        return share >= self.least or (share >= self.paraphrase and has_run(self.answers[k], part))

    def _verify(self, k: int, h: np.ndarray, starts: list[int], end: int) -> bool:
        """Whether a stretch of ``reach`` words from one of the starts has
        enough of item k."""
        reach, i = int(self.reach[k]), 0
        while i < len(starts):
            j = i
            while j < len(starts) and starts[j] <= starts[i] + self.COARSE:
                j += 1
            if self._enough(k, h[starts[i] : min(starts[j - 1] + reach, end)]) and any(self._enough(k, h[s : min(s + reach, end)]) for s in starts[i:j]):
                return True
            i = j
        return False


def searcher(index: Items):
    """Arrow UDF text -> ids of the items found, with one block of items in
    its closure."""

    def search(texts: pa.Array) -> pa.Array:
        out: list = []
        for _, h, at in words_of(texts):
            out += [sorted({index.ids[k] for k in got}) for got in index.found(h, at)]
        return pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(search, "array<bigint>")


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item_id: str = "item_id", item_text: str = "text", least: float = 0.8, paraphrase: float = 0.6, floor: float = 0.4, exact: bool = False, block: int = 2000) -> DataFrame:
    """``docs`` with ``contaminated`` and ``item_ids`` (sorted). The
    basis is fitted to all passages, the search reads every window of every
    document. ``floor`` is the least latent cosine of a
    candidate, ``exact`` takes candidates from the exact bound instead."""
    keep = [c for c in docs.columns if c.lower() not in ("contaminated", "item_ids")]
    items = benchmark.where(F.col(item_id).isNotNull() & (F.trim(F.coalesce(F.col(item_text), F.lit(""))) != "")).select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).distinct()
    items = stage(items.coalesce(8), "items")  # a small table: a few files
    n, df = document_frequencies(docs, text)
    idf = np.log((1 + n) / (1 + df)) + 0.1  # words of every document say next to nothing
    whole = docs.select(F.col(text).cast("string").alias("t")).where("t is not null")
    matrix = stage(passages(items.select("t").unionByName(whole), idf), "passages")
    number = matrix.agg(F.sum(F.octet_length("at") / 4)).first()[0]
    # a direction for each eight passages at most: a basis with as many directions as passages tells all of them apart
    weight = (latent_basis(matrix, max(1, min(32, int(number or 0) // 8))) * idf[:, None]).astype(np.float32)
    count = items.count()
    got = docs.select(*keep)
    lists = []
    for b in range(max(1, -(-count // block))):
        rows = [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64(F.lit("block"), "i", "t"), F.lit(max(1, -(-count // block)))) == b).collect()]
        index = Items(rows, weight, df, least, paraphrase, None if exact else floor)
        if not index.ids:
            continue

        lists.append(searcher(index)(F.col(text).cast("string")))
    found = F.array_sort(F.array_distinct(F.flatten(F.array(*lists)))) if lists else F.array().cast("array<bigint>")
    got = got.withColumn("item_ids", found)
    return got.withColumn("contaminated", F.size("item_ids") > 0)
