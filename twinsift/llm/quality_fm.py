"""Quality classifier: a factorisation machine over hashed words, structure
statistics and document metadata.

The score is sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The
pairwise sum takes time linear in the features by the identity
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Nulls and empty texts have no words and only zero statistics; they get the
score that this leaves. Rows with a null id or label are not learned from;
with labels of one kind or none the score is their share (0.5 for none).
Repeated label rows count once, by their mean. Long texts are read whole.
All columns of the input stay, except that new names replace old ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import buffers, remainder, slices, text_or_empty, word_hashes

WORDS = 8192
#: Kinds of bytes: 0 blank, 1 newline, 2 lower, 3 upper, 4 digit, 5 sentence mark, 6 other ASCII sign, 7 beyond ASCII.
_KIND = np.array(
    [
        1 if b == 10 else 0 if b in (9, 11, 12, 13, 32) else 2 if 97 <= b <= 122 else 3 if 65 <= b <= 90 else 4 if 48 <= b <= 57 else 5 if chr(b) in ".,;:'?" else 7 if b > 127 else 6
        for b in range(256)
    ],
    np.uint8,
)
STATS = 16


@dataclass(frozen=True)
class Model:
    bias: float
    linear: np.ndarray  # WORDS + STATS
    factors: np.ndarray  # (WORDS + STATS) x rank
    mean: np.ndarray  # of the statistics
    scale: np.ndarray


def rows_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x WORDS normalised word counts, texts x STATS statistics)."""
    n = len(at) - 1
    words, stats = np.zeros((n, WORDS), np.float32), np.zeros((n, STATS), np.float32)
    base, end = int(at[0]), int(at[-1])
    b = raw[base:end]
    if not len(b):
        return words, stats
    kind = _KIND[b]
    where, length, hashes = word_hashes(b, kind > 1, at[:-1] - base)
    bucket = (hashes >> np.uint64(64 - 13)).astype(np.int64)
    cut = np.searchsorted(where, at - base)
    for i in range(n):
        k = kind[at[i] - base : at[i + 1] - base]
        if not len(k):
            continue
        share = np.bincount(k, minlength=8) / len(k)
        lines = 1 + int((k == 1).sum())
        stats[i, :8] = share
        stats[i, 8] = np.log1p(len(k) / lines)
        w = slice(cut[i], cut[i + 1])
        m = cut[i + 1] - cut[i]
        if m:
            words[i] = np.bincount(bucket[w], minlength=WORDS)
            size = length[w]
            stats[i, 9:15] = np.log1p(size.mean()), np.log1p(size.std()), (size > 20).mean(), (size == 1).mean(), np.count_nonzero(words[i]) / m, words[i].max() / m
    np.sqrt(words, out=words)
    words /= np.maximum(np.sqrt((words * words).sum(1, keepdims=True)), 1e-9)
    return words, stats


def interactions(x: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The pairwise sum of every row, in linear time."""
    s = x @ factors
    return 0.5 * ((s * s).sum(1) - (x * x) @ (factors * factors).sum(1))


def margins(model: Model, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
    x = np.hstack([words, np.clip((stats - model.mean) / model.scale, -5, 5)]).astype(np.float32)
    return model.bias + x @ model.linear + interactions(x, model.factors)


def _chunks(texts: pa.Array, meta: pa.Array):
    raw, at = buffers(texts)
    size = np.log1p(np.maximum(np.nan_to_num(np.asarray(meta.cast(pa.float64()).fill_null(0.0))), 0))
    for i, j in slices(at, 1 << 20):
        for a in range(i, j, 256):
            b = min(a + 256, j)
            words, stats = rows_of(raw, at[a : b + 1])
            stats[:, 15] = size[a:b]
            yield words, stats


def _features(texts: pa.Array, meta: pa.Array) -> pa.Array:
    out = []
    for words, stats in _chunks(texts, meta):
        for w, s in zip(words, stats, strict=True):
            k = np.flatnonzero(w)
            out.append(s.astype("<f4").tobytes() + k.astype("<u2").tobytes() + w[k].astype("<f2").tobytes())
    return pa.array(out, pa.binary())


def train(docs: DataFrame, labels: DataFrame, fold: Column, text: str = "text", meta: str = "n_chars", most: int = 6000, rank: int = 8, epochs: int = 12, seed: int = 3) -> Model:
    """``docs`` rows in ``fold`` that ``labels(doc_id, quality)`` marks.
    ``most`` bounds the sample: the rows with the lowest hashes of their ids;
    their sparse features are what reaches the driver."""
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    ids = docs.where(fold).select("doc_id").distinct().join(marks, "doc_id").select("doc_id", "y", F.xxhash64(F.lit("fm"), "doc_id").alias("h")).orderBy("h", "doc_id").limit(most)
    chosen = F.broadcast(ids.select("doc_id", "y"))  # at most ``most`` rows of 12 bytes
    feats = F.arrow_udf(_features, "binary")
    rows = docs.select("doc_id", text, meta).join(chosen, "doc_id").select("doc_id", "y", feats(F.col(text).cast("string"), F.col(meta).cast("double")).alias("x")).orderBy(F.xxhash64(F.lit("fm"), "doc_id")).limit(2 * most).collect()
    zero = Model(0.0, np.zeros(WORDS + STATS, np.float32), np.zeros((WORDS + STATS, rank), np.float32), np.zeros(STATS, np.float32), np.ones(STATS, np.float32))
    y = np.array([r["y"] for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.5
        return Model(float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -6, 6)), zero.linear, zero.factors, zero.mean, zero.scale)
    raw = [bytes(r["x"]) for r in rows]
    stats = np.array([np.frombuffer(x, "<f4", STATS) for x in raw])
    mean, scale = stats.mean(0), stats.std(0) + 1e-3
    sparse = []
    for x in raw:
        n = (len(x) - 4 * STATS) // 4
        sparse.append((np.frombuffer(x, "<u2", n, 4 * STATS), np.frombuffer(x, "<f2", n, 4 * STATS + 2 * n)))
    stats = np.clip((stats - mean) / scale, -5, 5)
    rng = np.random.default_rng(seed)
    p = {"b": np.zeros(1, np.float32), "w": np.zeros(WORDS + STATS, np.float32), "v": rng.normal(0, 0.02, (WORDS + STATS, rank)).astype(np.float32)}
    first, second, t = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), 256):
            part = order[a : a + 256]
            x = np.zeros((len(part), WORDS + STATS), np.float32)
            for r, i in enumerate(part):
                x[r, sparse[i][0]] = sparse[i][1]
                x[r, WORDS:] = stats[i]
            s = x @ p["v"]
            m = p["b"] + x @ p["w"] + 0.5 * ((s * s).sum(1) - (x * x) @ (p["v"] ** 2).sum(1))
            g = (balance[part] * (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[part]) / len(part)).astype(np.float32)
            xg = x * g[:, None]
            grads = {"b": g.sum(keepdims=True), "w": xg.sum(0) + 1e-5 * p["w"], "v": xg.T @ s - p["v"] * ((x * xg).sum(0))[:, None] + 1e-4 * p["v"]}
            t += 1
            for k, d in grads.items():
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                p[k] -= 0.01 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return Model(float(p["b"][0]), p["w"], p["v"], mean.astype(np.float32), scale.astype(np.float32))


def scorer(model: Model):
    """Arrow UDF (text, metadata) -> score; the model's size is fixed."""

    def score(texts: pa.Array, meta: pa.Array) -> pa.Array:
        got = [1 / (1 + np.exp(-np.clip(margins(model, w, s).astype(np.float64), -30, 30))) for w, s in _chunks(texts, meta)]
        return pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())

    return F.arrow_udf(score, "double")


def classify(docs: DataFrame, model: Model, text: str = "text", meta: str = "n_chars", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= threshold)."""
    keep = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    got = docs.select(*keep, scorer(model)(text_or_empty(text), F.col(meta).cast("double")).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows of the fold that is never learned from: crc32 mod 4 is 2."""
    return F.coalesce(remainder(id_col, 4) == 2, F.lit(True))
