"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing columns, for every operator and stage."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from twinsift.llm import kd_shards, langid_ecoc, line_cuckoo, lsi_decontam, packing_cg, pii_feistel, pivot_index, quality_fm, simhash_tiles, suffix_array
from twinsift.llm import queries as q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, y int, kept string, n_lines string, w double, node string, item_ids string, key string"
LONG = " ".join(f"word{i % 977} thing{i % 31}" for i in range(40_000))
PASSAGE = "This passage of more than fifty bytes is in many documents of the table, word for word."


def _rows():
    texts = [None, "", "a", PASSAGE, PASSAGE, f"x {PASSAGE} y", LONG, LONG + " end", "\n\n", f"{PASSAGE}\nother", f"{PASSAGE.upper()}\nmore", "été où ça 123", "12 34 !!", PASSAGE, "short\n  short  "]
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(4, PASSAGE, "en", "s", 5), (None, PASSAGE, None, None, None), (None, None, None, None, None), (20, "été où ça 123", "fr", "s", 13)]
    return [(*r, "clash", "clash", 1, "clash", "clash", 0.5, "clash", "clash", "clash") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs():
    return [(r[0], r[1]) for r in _rows()]


def test_langid(docs, none):
    model = langid_ecoc.train(docs)
    got = langid_ecoc.identify(docs, model).collect()
    assert len(got) == len(_rows())
    for r in got:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in ("en", "fr")) if lettered else (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert r["shard"] == "clash" and 0 <= r["score"] <= 1
    assert langid_ecoc.identify(none, langid_ecoc.train(none)).count() == 0
    assert {r["lang_pred"] for r in langid_ecoc.identify(docs, langid_ecoc.train(none)).collect()} == {"und"}
    one = langid_ecoc.train(docs.where("lang = 'en'"))
    assert {r["lang_pred"] for r in langid_ecoc.identify(docs, one).collect()} == {"en", "und"}


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = langid_ecoc.codewords(n)
        gaps = (code.shape[1] - code @ code.T) / 2
        assert gaps[~np.eye(n, dtype=bool)].min() >= (1 if n < 4 else 3)


def test_quality(spark, docs, none):
    marks = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (8, 0, 0), (None, 1, 0), (6, None, 0), (12, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_fm.train(docs, marks, F.lit(True))
    got = quality_fm.classify(docs, model).collect()
    assert len(got) == len(_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert quality_fm.classify(none, quality_fm.train(none, marks, F.lit(True))).count() == 0
    flat = quality_fm.classify(docs, quality_fm.train(docs, marks.limit(0), F.lit(True))).collect()
    assert {round(r["score"], 6) for r in flat} == {0.5}


def test_interactions_identity():
    rng = np.random.default_rng(0)
    x, v = rng.normal(size=(4, 9)), rng.normal(size=(9, 3))
    want = [sum(r[i] * r[j] * (v[i] @ v[j]) for i in range(9) for j in range(i + 1, 9)) for r in x]
    assert np.allclose(quality_fm.interactions(x, v), want)


def test_suffix_dedup(docs, none):
    got = suffix_array.remove_repeats(docs).collect()
    want = sorted(zip([str(i) for i, _ in pairs()], brute.repeats(pairs()), strict=True))
    have = sorted((str(r["doc_id"]), (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())) for r in got)
    assert have == want
    assert all(r["shard"] == "clash" for r in got)
    assert suffix_array.remove_repeats(none).count() == 0


def test_suffix_dedup_common_and_periodic(spark):
    """Classes that travel as summaries, and runs of one repeated gram."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    body = [" ".join(word() for _ in range(20)) for _ in range(6)]
    rows = [(i, f"{word()} {word()} {body[i % 2]} {word()} {body[2 + i % 4]} {word()}") for i in range(700)]
    rows += [(1000 + i, "ab" * (40 + 13 * i)) for i in range(6)] + [(2000, "z" * 9000), (2001, "z" * 4500), (2002, "q" + "z" * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r[0]: tuple(r[1:]) for r in suffix_array.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()}
    assert got == {i: w for (i, _), w in zip(rows, brute.repeats(rows), strict=True)}


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = [*rng.integers(1, rng.integers(2, 6), rng.integers(1, 50)).tolist(), 0]
        assert suffix_array.suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_lines(docs, none):
    got = line_cuckoo.drop_lines(docs, least_docs=5, shards=3).collect()
    want = sorted((str(i), t or "", *w) for (i, t), w in zip(pairs(), brute.lines(pairs()), strict=True))
    of = {(str(i), t or ""): w for (i, t), w in zip(pairs(), brute.lines(pairs()), strict=True)}
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in got) == sorted((i, *of[i, t]) for i, t, *_ in want)
    assert any(r["n_dropped"] for r in got) and all(r["shard"] == "clash" for r in got)
    assert line_cuckoo.drop_lines(none).count() == 0


def test_line_store_is_reversible(spark):
    line = "a line that is certainly longer than forty characters, number {}"
    df = lambda a, b: spark.createDataFrame([(i, "\n".join(line.format(k) for k in (i % 7, i % 5, 100 + i))) for i in range(a, b)], "doc_id long, text string")
    facts = lambda s: sorted((bytes(r["key"]), r["n_docs"], r["last_doc"]) for r in s.refs.collect())

    def knows(s):  # every held key passes its filter; keys that nobody holds don't (but for a few)
        asked = line_cuckoo.pass_filters(s.refs.select("shard", "key"), s.filters).collect()
        return all(r["seen"] for r in asked)

    first = line_cuckoo.LineStore.build(df(0, 40), 4)
    more = first.insert(df(30, 80))
    whole = line_cuckoo.LineStore.build(df(0, 80), 4)
    assert facts(more) == facts(whole) and knows(more)
    back = more.delete(df(40, 80).select("doc_id"))
    assert facts(back) == facts(first) and knows(back)
    gone = line_cuckoo.lines_of(df(40, 80).select("doc_id", F.element_at(F.split("text", "\n"), 3).alias("text"))).withColumn("shard", line_cuckoo._shard(4))
    assert sum(r["seen"] for r in line_cuckoo.pass_filters(gone, back.filters).collect()) <= 2


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    f = line_cuckoo.Cuckoo.sized(len(h))
    assert f.insert(h) and f.has(h).all()
    other = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert f.has(other).mean() < 0.001
    f.delete(h[:1000])
    assert f.has(h[1000:]).all() and f.has(h[:1000]).mean() < 0.05
    full = line_cuckoo.Cuckoo(2)
    assert not full.insert(h[:100])


def test_simhash(docs, none):
    got = simhash_tiles.near_duplicates(docs).collect()
    rows = pairs()
    f = [brute.simhash(t) for _, t in rows]
    root = brute.components(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 4])
    least: dict = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{x:016x}", least.get(r)) for (i, _), x, r in zip(rows, f, root, strict=True))
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == want
    kept = simhash_tiles.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(least.values()))
    assert simhash_tiles.near_duplicates(none).count() == 0


@pytest.mark.parametrize("bucket", [16, 64, 8192])
def test_simhash_tiles_exact(spark, bucket):
    """Crowded buckets, dealt out again, link like one tile."""
    rng = np.random.default_rng(bucket)
    base = rng.integers(0, 1 << 62, 12)
    f = {int(b) for b in base}
    for b in base[:4]:
        for _ in range(150):
            f.add(int(b) ^ sum(1 << int(k) for k in rng.integers(0, 62, rng.integers(1, 4))))
    f = sorted(f)
    df = spark.createDataFrame([(x,) for x in f], "f long")
    got = {r[0]: r[1] for r in simhash_tiles.components(simhash_tiles.links(df, 4, bucket)).collect()}
    root = brute.components(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 4])
    assert [got.get(x, x) for x in f] == [f[r] for r in root]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (None, "x"), (3, ""), (4, "Who wrote the long book about whales and the sea in winter? It was old captain Ahab Melville."), (5, "one two")], "item_id long, text string")
    got = lsi_decontam.find(docs, items).collect()
    for r in got:
        assert (r["item_ids"] == [1]) == ("passage of more than" in (r["text"] or "").lower())
        assert r["contaminated"] == bool(r["item_ids"])
    told = "Well, who wrote that long book about whales and about the sea last winter? It was old captain Ahab Melville. I forgot."
    said = "Some words on other things entirely, and a good number of them too, so that nothing is near."
    plain = [(100 + i, f"In the end that was well and I forgot the last of it, number {i}.") for i in range(60)]  # usual words are usual
    more = spark.createDataFrame([(1, told), (2, said), (3, f"{said} {told} {said}"), *plain], "doc_id long, text string")
    found = {r["doc_id"]: r["item_ids"] for r in lsi_decontam.find(more, items).collect()}
    assert found == {1: [4], 2: [], 3: [4]} | {i: [] for i, _ in plain}
    assert not any(r["contaminated"] for r in lsi_decontam.find(docs, items.limit(0)).collect())
    assert lsi_decontam.find(none, items).count() == 0
    blocks = lsi_decontam.find(docs, items, block=2).collect()
    assert sorted(str((r["doc_id"], r["item_ids"])) for r in blocks) == sorted(str((r["doc_id"], r["item_ids"])) for r in got)


def test_common_words():
    rng = np.random.default_rng(6)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(1, 20)), rng.integers(0, 5, rng.integers(1, 20))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert lsi_decontam.common_words(a, b) == t[-1, -1]


def test_shards(docs, none):
    got = kd_shards.kd_shards(docs, shards=3).collect()
    assert len(got) == len(_rows()) and {r["shard"] for r in got} <= {0, 1, 2}
    texts: dict = {}
    for r in got:
        assert texts.setdefault(r["text_hash"], r["shard"]) == r["shard"]
    for k in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in pairs())
    assert sorted(r["text_crc32"] for r in got) == sorted(zlib.crc32((t or "").encode()) for _, t in pairs())
    assert kd_shards.kd_shards(none, shards=3).count() == 0


def test_shards_with_a_heavy_group(spark):
    rows = [(i, "copy " * 50) for i in range(300)] + [(1000 + i, f"text {i} " * (1 + i % 90)) for i in range(600)]
    got = kd_shards.kd_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=4, metadata=()).collect()
    load = np.bincount([r["shard"] for r in got], [r["size"] for r in got], 4)
    assert load.max() / load.min() < 1.05
    assert len({r["shard"] for r in got if r["doc_id"] < 300}) == 1
    by_bytes = kd_shards.kd_shards(spark.createDataFrame(rows, "doc_id long, text string"), target_bytes=60_000, metadata=()).collect()
    sizes = np.bincount([r["shard"] for r in by_bytes], [r["size"] for r in by_bytes])
    assert len(sizes) == -(-int(load.sum()) // 60_000)


def test_vectors(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + rng.normal(size=16) * 0.03 * (i // 40)).tolist()) for i in range(200)]
    rows += [(500, rows[0][1]), (0, rows[1][1]), (501, None), (502, []), (503, [0.0] * 16), (504, [float("nan")] * 16), (505, [float("inf")] + [1.0] * 15), (506, [1.0] * 3), (507, [1.0] * 3), (508, [-0.0, 1.0, 0.0]), (509, [0.0, 2.0, -0.0]), (None, rows[2][1]), (510, [None, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(str, pivot_index.near_duplicates(df, tile=8).select("vec_id", "n_links", "component_id").collect()))
    ok = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    near = []
    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                near.append((i, j))
    root = brute.components(len(rows), near)
    least: dict = {}
    for (v, _), r in zip(rows, root, strict=True):
        if v is not None:
            least[r] = min(v, least.get(r, v))
    want = sorted(f"Row(vec_id={v}, n_links={sum(i == k for i, _ in near)}, component_id={least.get(root[k])})" for k, (v, _) in enumerate(rows))
    assert got == want
    assert pivot_index.near_duplicates(df.limit(0)).count() == 0


def test_pivot_recall(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(300, 64))
    rows = [(i, (base[i % 300] + rng.normal(size=64) * 0.2).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = pivot_index.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = int((x @ x.T >= 0.95).sum()) - len(x)
    assert true > 1000 and 0.9 <= found / true <= 1


def test_packing(docs, none):
    got = packing_cg.pack(docs, q.vocabulary_path(), q.VOCABULARY).collect()
    total = sum(r["length"] for r in got)
    assert total == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    assert sum(r["start"] == 0 for r in got) == len(_rows())
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    assert sum(r["doc_tokens"] == 1 for r in got) == sum(not (t or "").strip() for _, t in pairs())
    assert packing_cg.pack(none, q.vocabulary_path(), q.VOCABULARY).count() == 0


def test_packing_words_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tok, words = Tokenizer.from_file(q.vocabulary_path()), packing_cg.Words(q.vocabulary_path(), "<u4", most=5)
    for t in ["", "It's  A test of\u0085ΟΔΟΣ Σ, don't!!", "a\x1cb\x1f c᠎d e​f", "<|endoftext|> x<|startoftext|>y", "é ́x İstanbul", "a\r\n\tb\x0b\x0cc ½ ² 12 ३4 ſ _x_", "日本語 テキスト ß ẞ ǅ", "﻿x   y　z"]:
        assert words.ids(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_patterns_are_near_the_bound():
    rng = np.random.default_rng(10)
    hist = {int(s): int(n) for s, n in zip(range(1, 257), rng.integers(0, 400, 256), strict=True)}
    plan = packing_cg.patterns(hist, 256)
    used: dict = {}
    for take, times in plan:
        assert sum(s * k for s, k in take.items()) <= 256
        for s, k in take.items():
            used[s] = used.get(s, 0) + k * times
    assert used == {s: n for s, n in hist.items() if n}
    bound = sum(s * n for s, n in hist.items()) / 256
    assert sum(t for _, t in plan) <= 1.05 * bound + 60


def test_pii(spark, docs, none):
    key = "k"
    text = "Card 4111 1111 1111 1111, no card 4111 1111 1111 1112, call +1 (017) 555-7713 or 415-555-2671, ssn 123-45-6789, ip 97.51.17.173 and 300.1.1.1, born 1984-02-29 or 29/02/1985 or 31.12.1999, write to Jo.Doe34@mail7.example.com; token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\". Version 2.0."
    df = spark.createDataFrame([(1, text), (2, f"again 4111 1111 1111 1111 {text}"), (3, None), (4, ""), (5, "plain words, 3 of them")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii_feistel.pseudonymise(df, key).collect()}
    out = got[1]["text"]
    assert got[1]["kinds"] == ["card", "date", "ip", "mail", "phone", "secret", "ssn"]
    for gone in ("4111 1111 1111 1111", "555-7713", "415-555-2671", "123-45-6789", "97.51.17.173", "1984-02-29", "31.12.1999", "Jo.Doe34", "04dbebab91ab"):
        assert gone not in out
    for stays in ("4111 1111 1111 1112", "300.1.1.1", "29/02/1985", "@mail7.example.com", "+1 (", "Version 2.0."):
        assert stays in out
    card = out[5:24]
    digits = [int(c) for c in card if c.isdigit()]
    assert sum(d if k % 2 else (2 * d - 9 * (d > 4)) for k, d in enumerate(digits)) % 10 == 0
    assert card in got[2]["text"][:30] and got[2]["text"].endswith(out[30:])
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "plain words, 3 of them" and got[5]["n_pii"] == 0
    # back again, for what is permuted
    num = "4111 1111 1111 1111 | 123-45-6789 | 97.51.17.173 | 1984-02-29 | +1 (017) 555-7713"
    once = pii_feistel.pseudonymise(spark.createDataFrame([(1, num)], "doc_id long, text string"), key)
    assert pii_feistel.pseudonymise(once, key, backwards=True).first()["text"] == num
    assert len(pii_feistel.pseudonymise(docs, key).collect()) == len(_rows())
    assert pii_feistel.pseudonymise(none, key).count() == 0
    with pytest.raises(ValueError):
        pii_feistel.pseudonymise(docs, "")


def test_pii_is_a_permutation(spark):
    ids = spark.range(100 * 99)
    for a, b in ((100, 99), (1, 9900), (3300, 3)):
        seen = ids.select(pii_feistel.feistel(F.col("id"), F.lit(a), F.lit(b), "k", "t").alias("x"))
        assert seen.distinct().count() == 9900 and seen.agg(F.min("x"), F.max("x")).first() == (0, 9899)
    days = ids.select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") * 7).cast("int")), "yyyy-MM-dd").alias("d"))
    new = days.select("d", pii_feistel._date(F.col("d"), "k", False).alias("p"))
    assert new.select("p").distinct().count() == 9900
    assert new.where(pii_feistel._date(F.col("p"), "k", True) != F.col("d")).count() == 0


def test_stages_on_odd_tables(spark, docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for d in (docs, docs.limit(0)):
        for k, (_, f) in enumerate(corpus_pipeline.STAGES):
            got = f(spark, d, folder)
            n = len(got.collect())
            assert n == 0 if not d.count() else n > 0
            if k + 1 < len(corpus_pipeline.STAGES):
                assert got.columns == corpus_pipeline.COLUMNS
