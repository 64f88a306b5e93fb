"""Operators 11 to 13: pieces against the library, trees and spelling groups
against plain versions and SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF0001
from tests.llm.test_edges import _rows, docs, none  # noqa: F401
from tests.oracle_compare import compare, duck
from twinsift.llm import merkle_climb, piece_bpe, spelling_gram
from twinsift.llm import queries as q

sha = lambda b: hashlib.sha256(b).hexdigest()

# --- 11 ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=q.pieces_path())


def le(ids):
    return np.array(ids, "<u4").tobytes()


def test_op11_equals_the_library(spark, library):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()}
    got = {r[0]: tuple(r[1:]) for r in q.op11_piece_bpe(spark, SF0001).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    want = {}
    for d, t in texts.items():
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want[d] = (len(ids), sha(le(ids)), sha(library.decode(ids).encode()))
    assert got == want


def test_pieces_on_odd_tables(docs, none, library):  # noqa: F811
    path = q.pieces_path()
    got = piece_bpe.decode(piece_bpe.encode(docs, path, to="kept"), path, ids="kept", to="node").collect()
    assert len(got) == len(_rows())
    for r in got:
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert bytes(r["kept"]) == le(ids) and r["node"] == library.decode(ids) and r["shard"] == "clash"
    assert piece_bpe.encode(none, path).count() == 0
    bare = piece_bpe.encode(docs, path, begin=None, end=None).where("text is null").first()
    assert bytes(bare["ids"]) == b""


def test_pieces_of_made_texts(library):
    model, rng = piece_bpe.pieces(q.pieces_path()), random.Random(7)
    texts = ["", " ", "   ", " " * 100, " " * 41 + "①" + " " * 33 + "x", "▁▁x▁", "\x00\n\t\r", "①②日本語のテキスト", "\U0001f600 " * 9, "é" * 700, "aaaa" * 300, "ab" * 2000, "the" * 900, "x" * 6000]
    for letters in ("abcdefgh theinonrest▁ é①\n.,0123", "ab ", "theandrsio", "▁ "):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 1500 if k % 9 == 0 else 120))) for k in range(150)]
    want = [library.encode(t) for t in texts]
    assert model.encode(texts) == [le(w) for w in want]
    assert model.decode([le(w) for w in want]) == [library.decode(w) for w in want]


def test_decoding_ids_that_no_text_gives(library):
    model, rng = piece_bpe.pieces(q.pieces_path()), random.Random(8)
    some = lambda: rng.choice([rng.randint(0, 31999), rng.randint(0, 260), rng.randint(130, 258), 28705])
    rows = [[some() for _ in range(rng.randint(0, 12))] for _ in range(1500)]
    assert model.decode([le(r) for r in rows]) == [library.decode(r) for r in rows]


def test_rounds_equal_the_heap():
    model, rng = piece_bpe.pieces(q.pieces_path()), random.Random(9)
    words = ["▁" + "".join(rng.choice("thenadirsol▁") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    sym = [model.char[[ord(c) for c in w]].astype(np.int64) for w in words]
    got, of = model.rounds(np.concatenate(sym), np.repeat(np.arange(len(words)), [len(s) for s in sym]))
    for k, s in enumerate(sym):
        assert got[of == k].tolist() == model.heap(s.tolist())


# --- 12 ---------------------------------------------------------------------


def tree_levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3]).encode()) for i in range(0, len(out[-1]), 3)])
    return out


def way(levels, p):
    """(left, right) siblings of leaf p, level by level."""
    out = []
    for level in levels[:-1]:
        run = p // 3 * 3
        out.append(("".join(level[run:p]), "".join(level[p + 1 : run + 3])))
        p //= 3
    return out


def plain_manifest(rows):
    """rows (tree, id, leaf, claimed) -> {(tree, id, leaf): [subroot, root, proof, folded, verified]}"""
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[0], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for t in names:
        trees[t].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    levels = {t: tree_levels([r[2] for r in trees[t]]) for t in names}
    above = tree_levels([levels[t][-1][0] for t in names])
    out = []
    for k, t in enumerate(names):
        for p, r in enumerate(trees[t]):
            met, folded = way(levels[t], p) + way(above, k), r[3]
            for a, b in met:
                folded = sha((a + folded + b).encode())
            out.append((str(t), str(r[1]), r[2], levels[t][-1][0], above[-1][0], "".join(a + b for a, b in met), folded, folded == above[-1][0]))
    return sorted(out)


def got_manifest(spark, rows):
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string, claimed string").repartition(3)
    got = merkle_climb.manifest(df, "source", "doc_id", keep=["source", "doc_id"])
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in got.collect())


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 4, None: 2}, {"a": 700, "b": 1, "c": 81, "é": 82, "": 3, None: 28}, {f"s{i}": 1 + i % 4 for i in range(130)}])
def test_merkle_equals_a_plain_tree(spark, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            leaf = sha(f"{i}".encode())
            rows.append((source, (i * 7919) % 100_003, leaf, leaf if i % 3 else sha(b"x")))
            i += 1
    assert got_manifest(spark, rows) == plain_manifest(rows)


def test_merkle_ties_nulls_and_repeats(spark):
    h = [sha(bytes([k])) for k in range(6)]
    rows = [("a", 1, h[0], h[0]), ("a", 1, h[1], h[2]), ("a", 1, h[0], h[0]), ("a", None, h[3], h[3]), (None, None, h[4], h[5]), (None, 2, h[4], h[4])]
    assert got_manifest(spark, rows) == plain_manifest(rows)
    empty = spark.createDataFrame([], "source string, doc_id long, leaf string, claimed string")
    assert merkle_climb.manifest(empty, "source", "doc_id").collect() == []


def test_op12_matches_sql(spark):
    r = compare(spark, "op12", q.op12_merkle_climb, q.OP12_SQL, SF001, duck(SF001))
    assert r["status"] == "match", r


def test_leaves_of_odd_rows(docs):  # noqa: F811
    of = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    got = docs.select("doc_id", "text", "lang", merkle_climb.leaf_hash([F.col("doc_id"), F.col("lang"), F.col("text")]).alias("h")).collect()
    assert all(r["h"] == sha("".join(map(of, (r["doc_id"], r["lang"], r["text"]))).encode()) for r in got)


# --- 13 ---------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_spellings(rows, least_letters=5, least=3, ratio=2, noise=97):
    counts: Counter = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if noise and h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least_letters:
                counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= least}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: x for w in n if near[w] and n[x := min(near[w], key=lambda y: (-n[y], y))] >= ratio * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, str(form.get(w)), root(w), n[w], len(near[w]), str(n.get(form.get(w)))) for w in n)


def got_spellings(df, **how):
    return sorted((r[0], str(r[1]), r[2], r[3], r[4], str(r[5])) for r in spelling_gram.group_spellings(df, **how).collect())


def test_op13_matches_sql(spark):
    r = compare(spark, "op13", q.op13_spelling_gram, q.OP13_SQL, SF001, duck(SF001))
    assert r["status"] == "match", r


def test_spellings_on_odd_tables(docs, none):  # noqa: F811
    pairs = [(r[0], r[1]) for r in _rows()]
    assert got_spellings(docs, noise=97, least=1) == plain_spellings(pairs, least=1)
    assert got_spellings(docs, noise=3, least=2) == plain_spellings(pairs, least=2, noise=3)
    assert spelling_gram.group_spellings(none).count() == 0
    assert spelling_gram.group_spellings(docs.where("text is null")).count() == 0


@pytest.mark.parametrize("tile", [8, 2048])
def test_spellings_of_made_words(spark, tile, monkeypatch):
    """Ties, chains of forms, repeated letters, long words, and blocks of many tiles."""
    monkeypatch.setattr(spelling_gram, "TILE", tile)
    rng = random.Random(11)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaaa", "aaaaa", "aaaaaaa", "z" * 3000, "z" * 2999, "z" * 1500 + "y" + "z" * 1499]
    words = []
    for k, w in enumerate(base):
        words += [w] * (1 + 3 * (k % 7) ** 2)
        words += [(w[: k % len(w)] + rng.choice("abcé") + w[k % len(w) + 1 :]).upper()] * (k % 5)
    for k, n in enumerate([3, 6, 12, 24, 48, 96, 192]):  # a chain: each form twice as frequent
        words += ["chain" + "x" * k] * n
    rng.shuffle(words)
    rows = [(i, ", ".join(words[i::40])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = got_spellings(df, least=1)
    assert got == plain_spellings(rows, least=1, noise=None)
    assert {r[2] for r in got if r[0].startswith("chain") and set(r[0][5:]) <= {"x"}} == {"chainxxxxxx"}


def test_blocks_are_bounded(spark):
    """A half that very many words share is dealt out in pairs of tiles."""
    words = spark.range(5000).select(F.concat(F.lit("abcde"), F.translate(F.lpad(F.col("id").cast("string"), 5, "0"), "0123456789", "ghijklmnop")).alias("word"), F.lit(3).cast("long").alias("n"))
    sizes = [r[0] for r in spelling_gram.blocks(words).groupBy("short", "side", "key", "i", "j").count().select("count").collect()]
    assert max(sizes) <= 2.3 * spelling_gram.TILE
