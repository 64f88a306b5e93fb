"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A text becomes words: it is cut where no piece of the vocabulary can go on,
which is before a run of blank marks, around ASCII signs that are next to no
other in any piece, and between letters and a sign that follows letters in
none (all read off the vocabulary when it is loaded). The words of a batch that
were not met before are laid out as one flat numpy array of symbols. A round finds the smallest pair rank of every word (a segmented
minimum), merges that pair wherever it occurs in the word, leftmost first
where occurrences overlap, and compacts the array; words without a pair left
leave it. Where a merged piece can at once take part in a pair of no larger
rank, only the leftmost occurrence is merged in that round, because that pair
would come first. So the result is the library's, whatever the ranks.

Words of more than ``LONG`` symbols are first cut where no piece holds both
neighbours; if a part is still longer, it is merged one pair at a time from a
heap, since rounds over it could take time with its square. Symbols that the
vocabulary lacks become byte pieces. A worker remembers up to ``KEPT`` words.

Null texts count as empty (begin and end ids only). Every row is encoded by
itself, so repeated rows and ties have equal ids and an empty table gives an
empty result. Long texts are encoded whole, some megabytes of words at a
time. All columns of the input stay; the new ones get the names asked for and
replace columns of those names.
"""

from __future__ import annotations

import heapq
import re
import string
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import text_or_empty

MARK = "▁"
#: Symbols that are no piece: this plus their code point.
OTHER = 1 << 20
_WIDTH = 1 << 22
NONE = np.int64(1 << 40)
LONG = 512
KEPT = 400_000
#: Symbols that one call of the rounds lays out.
FLAT = 1 << 20


class Pieces:
    """The vocabulary as arrays: pairs of symbols -> merged piece and rank."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.lib = lib = SentencePieceProcessor(model_file=path)
        n = lib.vocab_size()
        if n > OTHER:
            raise ValueError(f"{path}: more than {OTHER} pieces")
        names = [lib.id_to_piece(i) for i in range(n)]
        self.bytes = np.full(256, -1, np.int64)
        for i in range(n):
            if lib.is_byte(i):
                self.bytes[int(names[i][3:5], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError(f"{path}: no byte pieces to fall back to")
        score = {names[i]: lib.get_score(i) for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))}
        if any(lib.is_unused(i) for i in range(n)) or any(MARK in p.lstrip(MARK) for p in score):
            raise ValueError(f"{path}: unused pieces, or pieces beyond a word")
        self.plain = lib.normalize(" a  éﬁ\t① ") == f"{MARK}{MARK}a{MARK}{MARK}éﬁ\t①{MARK}"
        ids = {names[i]: i for i in range(n) if names[i] in score}
        ranks = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.char = np.arange(0x110000, dtype=np.int32) + OTHER
        for p, i in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        symbol = lambda p: int(self.char[ord(p)]) if len(p) == 1 else ids.get(p)
        pairs: dict[int, tuple[int, int]] = {}
        soonest: dict[str, int] = {}  # piece -> smallest rank of a pair that it takes part in
        near: set[int] = set()
        for p, i in ids.items():
            r = ranks[score[p]]
            near.update(int(self.char[ord(a)]) * _WIDTH + int(self.char[ord(b)]) for a, b in zip(p, p[1:], strict=False))
            for k in range(1, len(p)):
                a, b = symbol(p[:k]), symbol(p[k:])
                if a is not None and b is not None:
                    pairs[a * _WIDTH + b] = (i, r)
                    for part in (p[:k], p[k:]):
                        soonest[part] = min(r, soonest.get(part, r))
        self.pairs = pairs
        self.near = np.array(sorted(near), np.int64)
        self.word = self._cuts({a + b for p in ids for a, b in zip(p, p[1:], strict=False)})
        # rank, and in the lowest bit whether only the leftmost occurrence may be merged
        alone = {i: soonest.get(p, 1 << 40) <= ranks[score[p]] for p, i in ids.items()}
        self._store([(k, 2 * r + alone[i], i) for k, (i, r) in pairs.items()])
        # decoding: the bytes of every id
        shown = [b"" if lib.is_control(i) else " ⁇ ".encode() if lib.is_unknown(i) else bytes([int(names[i][3:5], 16)]) if lib.is_byte(i) else names[i].replace(MARK, " ").encode() for i in range(n)]
        self.size = np.array([len(b) for b in shown], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.raw = np.frombuffer(b"".join(shown), np.uint8)
        self.control = np.array([lib.is_control(i) for i in range(n)])
        self.byte = np.array([lib.is_byte(i) for i in range(n)])
        self.marked = np.array([p in ids and p.startswith(MARK) for p in names])
        self.ids: dict[str, bytes] = {}

    @staticmethod
    def _cuts(inside: set[str]) -> re.Pattern:
        """Words as a pattern; ``inside`` are the pairs of characters that some piece holds."""
        signs = [chr(c) for c in range(128) if chr(c) not in string.ascii_letters]
        held = set("".join(inside))
        alone = [c for c in signs if c not in held]
        after = [c for c in signs if c in held and not any(a + c in inside for a in string.ascii_letters)]
        alone, after = ("".join(map(re.escape, x)) for x in (alone, after))
        parts = [f"{MARK}+[A-Za-z]++(?![^{MARK}{after}{alone}])"]
        parts += [f"[{alone}]"] if alone else []
        return re.compile("|".join([*parts, f"{MARK}+[^{MARK}{alone}]*", f"[^{MARK}{alone}]+"]))

    def _store(self, pairs: list[tuple[int, int, int]]) -> None:
        """The pairs (key, rank, piece) as a table of open addresses."""
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE)
        self.made = np.zeros(1 << self.bits, np.int64)
        key, rank, made = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), (), ())))
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.rank[slot[won]], self.made[slot[won]] = key[won], rank[won], made[won]
            left = np.setdiff1d(left, won)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    # --- encoding ---------------------------------------------------------

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if there is no such pair) and merged piece."""
        key = a * _WIDTH + b
        slot = self._slot(key)
        there = self.keys[slot]
        lost = np.flatnonzero((there != key) & (there >= 0))  # the slot is another's: look on
        while len(lost):
            slot[lost] = (slot[lost] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[lost]]
            there[lost] = found
            lost = lost[(found != key[lost]) & (found >= 0)]
        return np.where(there == key, self.rank[slot], NONE), self.made[slot]

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no pair remains. ``word`` (ascending) says which word a
        symbol is of; returns the symbols left, with their words."""
        sym, of = symbols.astype(np.int64), word.astype(np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], made[:-1] = self._look(sym[:-1], sym[1:])
            rank[:-1][of[:-1] != of[1:]] = NONE
        while len(sym):
            start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            length = np.diff(np.append(start, len(sym)))
            least = np.minimum.reduceat(rank, start)
            out = np.repeat(least == NONE, length)
            if out.any():
                done.append((sym[out], of[out]))
                sym, of, rank, made = sym[~out], of[~out], rank[~out], made[~out]
                if not len(sym):
                    break
                least, length = least[least < NONE], length[least < NONE]
            at = np.flatnonzero(rank == np.repeat(least, length))
            first = np.concatenate([[True], of[at[1:]] != of[at[:-1]]])
            at = at[first | (rank[at] & 1 == 0)]
            # of occurrences that overlap, every other one of a run
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])
            head = np.flatnonzero(run)
            place = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
            at = at[place & 1 == 0]
            sym[at] = made[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, of, rank, made = sym[stay], of[stay], rank[stay], made[stay]
            now = at - np.arange(len(at))  # one symbol has gone for each merge before
            touched = np.concatenate([now, now[now > 0] - 1])
            last = touched == len(sym) - 1
            rank[touched[last]] = NONE
            touched = touched[~last]
            r, m = self._look(sym[touched], sym[touched + 1])
            rank[touched] = np.where(of[touched] == of[touched + 1], r, NONE)
            made[touched] = m
        if not done:
            return sym, of
        sym, of = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
        order = np.argsort(of, kind="stable")
        return sym[order], of[order]

    def heap(self, symbols: list[int]) -> list[int]:
        """The same for one long part, a pair at a time: smallest rank first, then leftmost."""
        sym, n, pairs = list(symbols), len(symbols), self.pairs
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        todo = []
        for i in range(n - 1):
            got = pairs.get(sym[i] * _WIDTH + sym[i + 1])
            if got:
                todo.append((got[1], i, sym[i], sym[i + 1], got[0]))
        heapq.heapify(todo)
        while todo:
            _, i, a, b, made = heapq.heappop(todo)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    got = pairs.get(sym[x] * _WIDTH + sym[y])
                    if got:
                        heapq.heappush(todo, (got[1], x, sym[x], sym[y], got[0]))
        return [s for s in sym if s >= 0]

    def _long(self, symbols: np.ndarray) -> np.ndarray:
        sym = symbols.astype(np.int64)
        key = sym[:-1] * _WIDTH + sym[1:]
        at = np.minimum(np.searchsorted(self.near, key), len(self.near) - 1)
        apart = np.concatenate([[0], np.cumsum(self.near[at] != key)])
        sizes = np.bincount(apart)
        big = sizes[apart] > LONG
        rest, of = self.rounds(sym[~big], apart[~big])
        parts = [(rest, of)]
        for k in np.flatnonzero(sizes > LONG).tolist():
            got = np.array(self.heap(sym[apart == k].tolist()) if len(sizes) < 64 else self.heap(sym[np.searchsorted(apart, k) : np.searchsorted(apart, k + 1)].tolist()), np.int64)
            parts.append((got, np.full(len(got), k)))
        sym, of = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        return sym[np.argsort(of, kind="stable")]

    def _as_ids(self, sym: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece become the pieces of their UTF-8 bytes."""
        odd = sym >= OTHER
        if not odd.any():
            return sym, of
        cp = np.where(odd, sym - OTHER, 0)
        n = np.where(odd, 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000), 1)
        ids, head = np.repeat(sym, n), np.cumsum(n) - n
        for size, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            here = odd & (n == size)
            for k in range(size):
                b = cp[here] >> (6 * (size - 1 - k))
                ids[head[here] + k] = self.bytes[(b & (0x3F if size > 1 else 0x7F)) | 0x80 if k else b | lead]
        return ids, np.repeat(of, n)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids (little-endian unsigned 32-bit) of words, in rounds over all of them."""
        got: dict[str, bytes] = {}
        if max(map(len, words), default=0) > LONG:
            for word in (w for w in words if len(w) > LONG):
                sym = self._long(self.char[np.frombuffer(word.encode("utf-32-le"), "<u4")])
                got[word] = self._as_ids(sym, np.zeros(len(sym), np.int64))[0].astype("<u4").tobytes()
            words = [w for w in words if len(w) <= LONG]
        if words:
            flat = self.char[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
            size = np.fromiter(map(len, words), np.int64, len(words))
            ids, of = self._as_ids(*self.rounds(flat, np.repeat(np.arange(len(words)), size)))
            raw = ids.astype("<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(of, minlength=len(words)))).tolist()
            got.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        return got

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.word.findall(MARK + text.replace(" ", MARK) if self.plain else self.lib.normalize(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as bytes, without begin and end."""
        out: list[bytes] = []
        known, i = self.ids, 0
        while i < len(texts):
            size, j = 0, i
            while j < len(texts) and (j == i or size + len(texts[j]) < FLAT):
                size += len(texts[j])
                j += 1
            cut = [self.words(t) for t in texts[i:j]]
            new = list(set(chain.from_iterable(cut)).difference(known))
            fresh: dict[str, bytes] = {}
            for part in self._layouts(new):
                fresh |= self.learn(part)
            known.update(fresh)
            out.extend(b"".join(map(known.__getitem__, words)) for words in cut)
            if len(known) > KEPT:
                for w in fresh:
                    del known[w]
            else:  # long words take room and seldom come again
                for w in [w for w in fresh if len(w) > 64]:
                    del known[w]
            i = j
        return out

    @staticmethod
    def _layouts(words: list[str]) -> list[list[str]]:
        """Words in parts of about ``FLAT`` symbols."""
        total = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) if words else np.zeros(0, np.int64)
        cuts = np.flatnonzero(np.diff(total // FLAT)) + 1
        ends = [*cuts.tolist(), len(words)]
        return [words[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True) if b > a]

    # --- decoding ---------------------------------------------------------

    def decode(self, rows: list[bytes]) -> list[str]:
        """Texts of rows of ids (bytes as above)."""
        if not rows:
            return []
        ids = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
        n = np.array([len(r) // 4 for r in rows], np.int64)
        if len(ids) and ids.max() >= len(self.size):
            raise ValueError("ids beyond the vocabulary")
        size, at = self.size[ids], self.at[ids]
        # the blank that encoding put before a text
        of = np.repeat(np.arange(len(rows)), n)
        real = np.flatnonzero(~self.control[ids])
        first = real[np.concatenate([[True], of[real][1:] != of[real][:-1]])] if len(real) else real
        first = first[self.marked[ids[first]]]
        size = size.copy()
        size[first] -= 1
        at[first] += 1
        ends = np.cumsum(size)
        raw = self.raw[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        stop = np.concatenate([[0], ends])[np.cumsum(n)].tolist()
        # a control piece inside a row parts the bytes on either side of it
        odd = np.zeros(len(rows), bool)
        inside = np.flatnonzero(self.control[ids[1:-1]]) + 1
        inside = inside[(of[inside - 1] == of[inside]) & (of[inside + 1] == of[inside]) & self.byte[ids[inside - 1]]]
        odd[of[inside]] = True
        out = []
        for k, (a, b) in enumerate(zip([0, *stop[:-1]], stop, strict=True)):
            try:
                out.append(self._mended(rows[k]) if odd[k] else raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(self._mended(rows[k]))
        return out

    def _mended(self, row: bytes) -> str:
        """Each byte piece that is part of no character shows as U+FFFD."""
        ids = np.frombuffer(row, "<u4").tolist()
        out, k, first = [], 0, True
        while k < len(ids):
            part = self.raw[self.at[ids[k]] : self.at[ids[k]] + self.size[ids[k]]].tobytes()
            if not self.byte[ids[k]]:
                out.append(part[first and bool(self.marked[ids[k]]) :].decode())
                first &= bool(self.control[ids[k]])
                k += 1
                continue
            first = False
            run = bytearray()
            for i in ids[k : k + 4]:
                if not self.byte[i]:
                    break
                run.append(self.raw[self.at[i]])
            for m in range(1, len(run) + 1):
                try:
                    out.append(run[:m].decode())
                    k += m
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("\ufffd")
                k += 1
        return "".join(out)


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary at ``path``, read once a process."""
    got = _LOADED.get(path)
    if got is None:
        got = _LOADED[path] = Pieces(path)
    return got


def _some(rows: pa.Array, most: int = 256) -> list[list]:
    return [rows.slice(a, most).to_pylist() for a in range(0, len(rows), most)]


def encoder(path: str, begin: int | None = 1, end: int | None = 2):
    """An Arrow UDF: text -> ids, as little-endian unsigned 32-bit integers."""
    head, tail = (b"" if i is None else np.array([i], "<u4").tobytes() for i in (begin, end))

    def run(texts: pa.Array) -> pa.Array:
        model = pieces(path)
        return pa.array([head + ids + tail for part in _some(texts) for ids in model.encode(["" if t is None else t for t in part])], pa.binary())

    return F.arrow_udf(run, "binary")


def decoder(path: str):
    """An Arrow UDF: ids as bytes -> text (null for null)."""

    def run(rows: pa.Array) -> pa.Array:
        model = pieces(path)
        out: list[str | None] = []
        for part in _some(rows):
            texts = model.decode([r or b"" for r in part])
            out += [None if r is None else t for r, t in zip(part, texts, strict=True)]
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def encode(docs: DataFrame, path: str, begin: int | None = 1, end: int | None = 2, text: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text (binary; see ``encoder``)."""
    return docs.withColumn(to, encoder(path, begin, end)(text_or_empty(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of each row of ids."""
    return df.withColumn(to, decoder(path)(F.col(ids)))
