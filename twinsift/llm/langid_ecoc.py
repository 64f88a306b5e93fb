"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary classifier per bit
looks at hashed byte n-grams; a text gets the language whose codeword loses
least against the classifiers' margins, each bit weighted by how well it knew
that language in training. Two codewords that are about as near mark the
result as ambiguous.

Nulls, empty texts and texts without a letter: ``und``, score 0. Rows without
labels, id or text are not learned from; with no labelled row at all every
text is ``und``, with one language every text with a letter is of it. Repeated
rows are predicted alike. Very long texts are read whole, in pieces that add
up. The result keeps all columns of the input; a clash with the new names is
resolved by replacing the old column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import added_up, buffers, own_names, remainder, slices, stage, text_or_empty

BUCKETS = 4096
#: ASCII letters in lower case, other ASCII as blanks, everything beyond as it is.
_PLAIN = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)], np.uint32)


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weight: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits, rows add up to 1


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Up to four languages get all distinct splits; more get the random code
    with the largest least distance of 64 drawn."""
    if n <= 4:
        rows = [[1 if (s >> i) & 1 else -1 for i in range(n)] for s in range(1, 2 ** (n - 1))] or [[1] * n]
        return np.array(rows, np.float32).T
    rng, bits = np.random.default_rng(seed), max(15, int(np.ceil(5 * np.log2(n))))
    best, far = None, -1
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.float32), (n, bits))
        near = ((bits - code @ code.T) / 2 + np.eye(n) * bits).min()
        if near > far and (np.abs(code.sum(0)) < n).all():
            best, far = code, near
    return best if best is not None else code


def ngrams(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of L2-normalised square roots of hashed 1- to 3-gram counts."""
    out = np.zeros((len(at) - 1, BUCKETS), np.float32)
    shift = np.uint32(32 - 12)
    for i in range(len(at) - 1):
        for a in range(int(at[i]), int(at[i + 1]), 1 << 18):  # long texts in pieces that overlap by two bytes
            b = _PLAIN[raw[a : min(int(at[i + 1]), a + (1 << 18) + 2)]]
            n = min(len(b), 1 << 18)
            two = b[:-1] * np.uint32(257) + b[1:]
            three = two[:-1] * np.uint32(263) + b[2:]
            for k, x in enumerate((b[:n], two[:n], three[:n])):
                out[i] += np.bincount((x * np.uint32(2654435761) + np.uint32(k * 0x3D4D51CB)) >> shift, minlength=BUCKETS)
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


#: A bucket that a text has, and its value.
_CELL = np.dtype([("k", "<u2"), ("v", "<f2")])


def _features(texts: pa.Array) -> pa.Array:
    """The n-gram row of each text as the cells that aren't zero."""
    raw, at = buffers(texts)
    out: list[bytes] = []
    for i, j in slices(at, 1 << 20):
        for x in ngrams(raw, at[i : j + 1]):
            cells = np.empty(np.count_nonzero(x), _CELL)
            cells["k"] = np.flatnonzero(x)
            cells["v"] = x[cells["k"]]
            out.append(cells.tobytes())
    return pa.array(out, pa.binary())


def train(docs: DataFrame, label: str = "lang", text: str = "text", id_col: str = "doc_id", steps: int = 24) -> Model:
    """Learn from all rows with a label. Their n-gram rows are staged; each step
    is one pass over all of them, in which tasks make their shares of the
    gradient and Spark adds them up. The driver holds only sums of the model's
    size. Languages count the same, however many rows they have."""
    known = docs.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & text_or_empty(text).rlike(r"\p{L}"))
    feats = F.arrow_udf(_features, "binary")
    rows = stage(known.select(F.col(label).cast("string").alias("l"), feats(F.col(text).cast("string")).alias("x")), "ngrams")
    counts = {r[0]: r[1] for r in rows.groupBy("l").count().collect()}
    langs = sorted(counts)
    if len(langs) < 2:
        return Model(langs, np.ones((len(langs), 1), np.float32), np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), np.ones((len(langs), 1), np.float32))
    code = codewords(len(langs))
    each = np.array([1 / len(langs) / counts[lang] for lang in langs], np.float32)  # weight of a row of each language
    w, bias = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m1, m2, n1, n2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(bias), np.zeros_like(bias)
    for t in range(1, steps + 1):  # Adam on the logistic loss

        def slope(batches, w=w, bias=bias):
            total = np.zeros((BUCKETS + 1, code.shape[1]))
            for x, y in _blocks(batches, langs):
                g = -code[y] * each[y][:, None] / (1 + np.exp(np.clip(code[y] * (x @ w + bias), -30, 30)))
                total[:-1] += x.T @ g
                total[-1] += g.sum(0)
            return total

        g = added_up(rows, slope, (BUCKETS + 1, code.shape[1])).astype(np.float32)
        for p, d, a, b in ((w, g[:-1] + 1e-5 * w, m1, m2), (bias, g[-1], n1, n2)):
            a += 0.1 * (d - a)
            b += 0.01 * (d * d - b)
            p -= 0.3 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)

    def right(batches):
        total = np.zeros(code.shape)
        for x, y in _blocks(batches, langs):
            np.add.at(total, y, (x @ w + bias) * code[y] > 0)
        return total

    trust = (added_up(rows, right, code.shape) / np.array([counts[lang] for lang in langs])[:, None]).astype(np.float32) + 1e-3
    return Model(langs, code, w, bias, trust / trust.sum(1, keepdims=True))


def _blocks(batches, langs: list[str]):
    """(n-gram rows, places of their labels in ``langs``), some hundred at a time."""
    place = pa.array(langs, pa.string())
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            held = [v.as_buffer() for v in part.column(1)]
            cells = np.frombuffer(b"".join(held), _CELL)
            x = np.zeros((part.num_rows, BUCKETS), np.float32)
            x[np.repeat(np.arange(len(held)), [b.size // _CELL.itemsize for b in held]), cells["k"]] = cells["v"]
            yield x, np.asarray(pc.index_in(part.column(0), value_set=place))


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest language, its probability, the lead over the second)."""
    loss = np.einsum("lb,nlb->nl", model.trust, np.exp(-np.clip(model.code[None] * margins[:, None, :], -8, 8)))
    p = np.exp(-2 * (loss - loss.min(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    top = np.sort(p, 1)
    lead = top[:, -1] - top[:, -2] if p.shape[1] > 1 else np.ones(len(p))
    return best, top[:, -1], lead


def predictor(model: Model):
    """Arrow UDF text -> struct(lang, score, lead) with the fixed-size model
    (4096 buckets a bit) in its closure."""

    def predict(texts: pa.Array) -> pa.Array:
        raw, at = buffers(texts)
        got = [decode(model, ngrams(raw, at[a : b + 1]) @ model.weight + model.bias) for i, j in slices(at, 1 << 20) for a, b in ((k, min(k + 256, j)) for k in range(i, j, 256))]
        best, score, lead = (np.concatenate(x) if got else np.zeros(0) for x in zip(*got, strict=True)) if got else (np.zeros(0, int), np.zeros(0), np.zeros(0))
        return pa.StructArray.from_arrays([pa.array([model.langs[k] for k in best], pa.string()), pa.array(score, pa.float64()), pa.array(lead, pa.float64())], ["lang", "score", "lead"])

    return F.arrow_udf(predict, "lang string, score double, lead double")


@own_names
def identify(docs: DataFrame, model: Model, text: str = "text", least_lead: float = 0.1) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``."""
    letters = text_or_empty(text).rlike(r"\p{L}")
    if not model.langs:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "ambiguous": F.lit(False)})
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "ambiguous")]
    got = docs.select(*keep, predictor(model)(F.col(text).cast("string")).alias("__p"), letters.alias("__l"))
    sure: Column = F.col("__l")
    return got.select(
        *keep,
        F.when(sure, F.col("__p.lang")).otherwise("und").alias("lang_pred"),
        F.when(sure, F.least(F.lit(1.0), F.col("__p.score"))).otherwise(0.0).alias("score"),
        F.when(sure, F.col("__p.lead") < least_lead).otherwise(False).alias("ambiguous"),
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Rows of the fold that is never learned from: crc32 mod 3 is 1."""
    return F.coalesce(remainder(id_col, 3) == 1, F.lit(True))
