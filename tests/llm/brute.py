"""Plain versions of the training-data operators, for small tables."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import xxhash

BLANK = b" \t\n\x0b\x0c\r"


def repeats(rows, window=50):
    """rows (id, text) -> {(id, n): (n_bytes, n_removed, n_spans, sha)} in row order."""
    late = 1 << 63
    first = {}
    texts = [((late if i is None else i), (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for k in range(len(b) - window + 1):
            w = b[k : k + window]
            first[w] = min(i, first.get(w, late))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if first[b[k : k + window]] < i:
                gone[k : k + window] = True
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def lines(rows, least_docs=5, least=40):
    def key(x):
        s = x.strip(BLANK.decode())
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s) if len(s) >= least else None

    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and key(x):
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if not (len(held.get(key(x), ())) >= least_docs and i != max(held[key(x)]))]
        out.append((len(all_), len(all_) - len(kept), "\n".join(kept)))
    return out


def simhash(text, shingle=4):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).translate(bytes(range(256))).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    h = [xxhash.xxh64_intdigest(b" ".join(words[k : k + shingle]), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def crc(b: bytes) -> int:
    return zlib.crc32(b)
