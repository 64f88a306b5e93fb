"""Cases where a faster or simpler way once did less than the whole job."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from twinsift.llm import common, langid_ecoc, lsi_decontam, packing_cg, pii_feistel, suffix_array
from twinsift.llm.queries import vocabulary_path

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _word(rng):
    return "".join(rng.choice(list(ALPHABET), 7))


def _benchmark(rng):
    """Items, and documents with them: whole between rare words, paraphrased
    with the heavier or the lighter words changed, and one item in a third of
    the documents."""
    usual, seldom = [_word(rng) for _ in range(80)], [_word(rng) for _ in range(600)]
    prose = lambda n, rare: " ".join(rng.choice(seldom if rng.random() < rare else usual) for _ in range(n))
    items = [(k, f"{prose(int(rng.integers(8, 40)), 0.3)}. {prose(6, 0.3)}.") for k in range(12)]
    items.append((50, f"{prose(32, 0.0)}. {prose(6, 0.0)}."))  # in a third of the documents
    texts = []
    for d in range(240):
        k, text = items[d % len(items)] if d % 3 else items[-1]
        words = text.split()
        body = len(words) - 6
        share = rng.choice([0.0, 0.1, 0.2, 0.3, 0.4, 0.5])
        heavy = sorted(range(body), key=lambda i: (words[i] in usual) != (d % 2 == 0))
        for i in heavy[: int(share * len(words))]:
            words[i] = _word(rng)  # rare and foreign
        around = " ".join(_word(rng) for _ in range(12))
        texts.append((d, f"{around} {' '.join(words)} {around}" if d % 6 != 4 else prose(150, 0.2)))
    return items, texts


def _by_force(index, texts):
    """All documents x items x starts, without any gate."""
    out = {}
    for d, text in texts:
        _, h, _ = next(lsi_decontam.words_of(pa.array([text])))
        found = set()
        for k, words in enumerate(index.words):
            n = len(words)
            for s in range(len(h)):
                part = h[s : s + n + n // 4 + 28]
                share = lsi_decontam.common_words(words, part) / n
                if share >= 0.8 or share >= 0.6 and lsi_decontam.has_run(index.answers[k], part):
                    found.add(index.ids[k])
                    break
        out[d] = sorted(found)
    return out


def test_passages_between_rare_words(spark):
    rng = np.random.default_rng(3)
    usual = [_word(rng) for _ in range(60)]
    item = " ".join(rng.choice(usual) for _ in range(38))
    rows = []
    for d in range(90):
        around = [" ".join(_word(rng) for _ in range(12)) for _ in range(2)]
        rows.append((d, f"{around[0]} {item} {around[1]}" if d % 3 == 0 else f"{around[0]} {around[1]}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lsi_decontam.find(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["item_ids"] == [7]} == set(range(0, 90, 3))
    assert sum(r["contaminated"] for r in got) == 30


def test_decontamination_equals_brute_force(spark):
    """The exact bound finds what brute force finds, the latent search at least
    nine tenths of it, paraphrases included, and nothing else."""
    items, texts = _benchmark(np.random.default_rng(4))
    docs, told = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = _by_force(lsi_decontam.Items(items, np.ones((lsi_decontam.BUCKETS, 2), np.float32), np.ones(lsi_decontam.BUCKETS), 0.8, 0.6), texts)
    assert sum(map(bool, want.values())) > 100
    exact = {r["doc_id"]: r["item_ids"] for r in lsi_decontam.find(docs, told, exact=True).collect()}
    assert exact == want
    latent = {r["doc_id"]: r["item_ids"] for r in lsi_decontam.find(docs, told).collect()}
    pairs = lambda x: {(d, i) for d, ids in x.items() for i in ids}
    assert pairs(latent) <= pairs(want) and len(pairs(latent)) >= 0.9 * len(pairs(want))


def test_recall_on_a_table(spark):
    """All documents of sf0.01: what the latent search finds of what the exact bound finds."""
    from tests.conftest import SF001

    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = lambda exact: {(r["doc_id"], i) for r in lsi_decontam.find(docs, items, exact=exact).collect() for i in r["item_ids"]}
    want, got = pairs(True), pairs(False)
    assert len(want) > 10 and got <= want and len(got) >= 0.97 * len(want)


def test_paraphrase_among_few_documents(spark):
    items = spark.createDataFrame([(4, "Who wrote the long book about whales and the sea in winter? It was old captain Ahab Melville.")], "item_id long, text string")
    told = "Well, who wrote that long book about whales and about the sea last winter? It was old captain Ahab Melville. I forgot."
    said = "Some words on other things entirely, and a good number of them too, so that nothing is near."
    docs = spark.createDataFrame([(1, told), (2, said), (3, f"{said} {told} {said}")], "doc_id long, text string")
    assert {r["doc_id"]: r["item_ids"] for r in lsi_decontam.find(docs, items).collect()} == {1: [4], 2: [], 3: [4]}


def test_the_basis_decides():
    """With the exact bound any basis finds the same. The latent search finds
    only what its basis brings near: one that knows the items' words finds their
    paraphrases among words that it doesn't know, a random one loses some, and
    one that knows no word finds nothing."""
    rng = np.random.default_rng(5)
    items, texts = _benchmark(rng)
    df = np.ones(lsi_decontam.BUCKETS)
    flat = np.concatenate([h for _, t in items for _, h, _ in lsi_decontam.words_of(pa.array([t]))])
    known = np.zeros((lsi_decontam.BUCKETS, 1), np.float32)
    known[lsi_decontam.bucket_of(flat)] = 1
    random = rng.normal(size=(lsi_decontam.BUCKETS, 64)).astype(np.float32)

    def found(basis, floor):
        index = lsi_decontam.Items(items, basis, df, 0.8, 0.6, floor)
        got = [sorted(g) for _, h, at in lsi_decontam.words_of(pa.array([t for _, t in texts])) for g in index.found(h, at)]
        return sum(map(len, got)), got

    assert found(random, None) == found(known * random, None)
    all_, floor = found(random, None)[0], 0.8
    assert found(known * random, floor)[0] > 1.1 * found(random, floor)[0] > 0
    assert found(known * random, floor)[0] >= 0.8 * all_ and found(0 * random, floor)[0] == 0


def test_windows_of_every_length(spark):
    """Items of one word to hundreds, verbatim at the start, in the middle and at the end of texts."""
    rng = np.random.default_rng(6)
    items = [(n, " ".join(_word(rng) for _ in range(n))) for n in (1, 2, 5, 11, 12, 13, 30, 100, 400)]
    around = lambda n: " ".join(_word(rng) for _ in range(n))
    texts = []
    for n, t in items:
        texts += [(n * 10, t), (n * 10 + 1, f"{t} {around(45)}"), (n * 10 + 2, f"{around(45)} {t}"), (n * 10 + 3, f"{around(7)} {t} {around(53)}")]
    docs, told = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in lsi_decontam.find(docs, told).collect()}
    assert got == {d: [d // 10] for d, _ in texts}


def test_cards_beside_other_numbers(spark):
    card = "4111 1111 1111 1111"
    texts = [
        "pay 4111111111111111 123 now", f"row 12 {card} end", f"{card} 123", f"1234 {card} 99 3782 822463 10005",
        "token=1234567890123456", "key: 1234-5678-9012-3456-78", "12 415-555-2671 99 and 7 123-45-6789 22 33 44", f"{card} 415-555-2671",
        "1234567890123456", "1 " * 30_000, "12345678901234567890123456",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii_feistel.pseudonymise(docs, "k").collect()}
    for d in (0, 1, 2, 3, 7):
        assert "card" in got[d]["kinds"] and card not in got[d]["text"] and card.replace(" ", "") not in got[d]["text"]
    assert got[3]["n_pii"] == 2 and "822463" not in got[3]["text"]
    assert got[0]["text"].endswith(" 123 now") and got[0]["text"].startswith("pay ") and got[1]["text"].startswith("row 12 ")
    assert [got[d]["kinds"] for d in (4, 5)] == [["secret"]] * 2 and "1234567890123456" not in got[4]["text"] and "5678-9012" not in got[5]["text"]
    assert got[6]["kinds"] == ["phone", "ssn"] and "555-2671" not in got[6]["text"] and "45-6789" not in got[6]["text"]
    assert got[7]["n_pii"] == 2 and "555-2671" not in got[7]["text"]
    for d in (8, 9, 10):
        assert got[d]["n_pii"] == 0 and got[d]["text"] == texts[d]
    for d, t in enumerate(texts):  # lengths and signs stay
        assert len(got[d]["text"]) == len(t) and got[d]["text"].translate(str.maketrans("", "", "0123456789")) == t.translate(str.maketrans("", "", "0123456789"))
    back = pii_feistel.pseudonymise(docs.where("doc_id in (0, 7)").select("doc_id", F.lit("4111 1111 1111 1111").alias("text")), "k")
    assert pii_feistel.pseudonymise(back, "k", backwards=True).first()["text"] == card


def test_classes_keep_all_bits(monkeypatch):
    shared = b"a passage of rather more than fifty bytes that both of the documents hold"
    texts = [b"one beginning, " + shared + b" and its end", b"quite another " + shared + b", then more"]
    real = suffix_array.xxhash.xxh64_intdigest
    monkeypatch.setattr(suffix_array.xxhash, "xxh64_intdigest", lambda x: real(x) & 0xFFFF000000000007)  # alike in 48 bits
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array([t.decode() for t in texts], pa.large_string())], ["doc", "ord", "t"])
    rows = [r for b in suffix_array._meet(50)(suffix_array._occurrences(50, 20, 1)(iter([batch]))) for r in b.to_pylist()]
    key = {r["key"] for r in rows if r["kind"] == 1}
    assert key and all(len({r["class"] for r in rows if r["kind"] == 1 and r["key"] == k}) == 2 for k in key)


def test_texts_stay_without_a_label(spark):
    rows = [(k, t, None, "s", 1) for k, t in enumerate(["plain words", "12 34", None, "more words"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()} == {0, 3}


def test_language_id_has_effect(spark, monkeypatch):
    """Null and wrong labels take the prediction; a language that isn't wanted goes."""
    from tests.conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("lang is not null and length(text) > 400")
    told = {r["doc_id"]: r["lang"] for r in docs.collect()}
    langs = sorted(set(told.values()))
    assert len(langs) > 1
    odd = docs.withColumn("lang", F.when(F.col("doc_id") % 10 == 1, F.lit(None)).when(F.col("doc_id") % 40 == 2, F.lit(langs[0])).otherwise(F.col("lang")))
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, odd, "").collect()}
    assert set(got) == set(told) and np.mean([got[d] == told[d] for d in got]) >= 0.97
    assert np.mean([got[d] == told[d] for d in got if d % 10 == 1]) >= 0.95
    monkeypatch.setattr(corpus_pipeline, "WANTED", (langs[0],))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert np.mean([told[d] == langs[0] for d in kept]) >= 0.97 and {d for d in told if told[d] == langs[0]} <= kept


INTERNAL = ["__m", "__t", "__k", "__p", "__l", "__keys", "__id", "__n", "__cut", "__s", "__c", "__doc", "__size", "__crc", "__sha", "__d0", "__d_id", "__shard", "__b", "__in", "__gone", "input__m"]


def _operators():
    from twinsift.llm import kd_shards, langid_ecoc, line_cuckoo, simhash_tiles

    return {
        "op2": lambda d: suffix_array.remove_repeats(d),
        "op3": lambda d: pii_feistel.pseudonymise(d, "k"),
        "op4": lambda d: langid_ecoc.identify(d, langid_ecoc.train(d)),
        "op5": lambda d: lsi_decontam.find(d, d.select(F.col("doc_id").alias("item_id"), "text").limit(1)),
        "op6": lambda d: kd_shards.kd_shards(d, shards=2),
        "op9": lambda d: line_cuckoo.drop_lines(d),
        "op10": lambda d: simhash_tiles.keep_one(d),
    }


@pytest.mark.parametrize("name", sorted(_operators()))
def test_columns_with_internal_names_stay(spark, name):
    rows = [(i, f"some text number {i * i}, card 4111 1111 1111 1111, of a good many words\nline {i}", "en" if i % 2 else "fr") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    plain = _operators()[name](docs)
    named = docs.select("*", *[F.concat(F.lit(c), "doc_id").alias(c) for c in INTERNAL])
    got = _operators()[name](named)
    assert set(INTERNAL) <= set(got.columns)
    for r in got.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in INTERNAL)
    same = [c for c in plain.columns if c not in ("text",) or name != "op6"]
    assert sorted(map(str, got.select(*same).collect())) == sorted(map(str, plain.select(*same).collect()))


def test_basis_is_fitted_to_every_passage(spark, monkeypatch):
    """Far more documents than any sample: each of their passages is a row of
    the matrix, as is each of the items', and the products add all of them up."""
    docs = spark.range(2100).selectExpr("id as doc_id", "concat('alpha w', id, ' beta w', id % 7) as text").union(spark.createDataFrame([(9000, " ".join(f"v{i}" for i in range(150))), (9001, None), (9002, "")], "doc_id long, text string"))
    items = spark.createDataFrame([(1, "gamma delta epsilon zeta")], "item_id long, text string")
    seen, basis = [], lsi_decontam.latent_basis
    monkeypatch.setattr(lsi_decontam, "latent_basis", lambda matrix, *a: seen.append(matrix) or basis(matrix, *a))
    lsi_decontam.find(docs, items)
    rows = []
    for r in seen[0].collect():
        ends = np.frombuffer(r["at"], "<i4")
        for a, z in zip([0, *ends[:-1]], ends, strict=True):
            row = np.zeros(lsi_decontam.BUCKETS)
            row[np.frombuffer(r["idx"], "<u2")[a:z]] = np.frombuffer(r["val"], "<f4")[a:z]
            rows.append(row)
    assert len(rows) == 2100 + 3 + 1 and np.allclose([x @ x for x in rows], 1)
    q = np.random.default_rng(3).normal(size=(lsi_decontam.BUCKETS, 3)).astype(np.float32)
    some = np.flatnonzero(np.sum(rows, axis=0))
    small = np.array(rows)[:, some]
    assert np.allclose(lsi_decontam._product(seen[0], q)[some], small.T @ (small @ q[some]), rtol=1e-3, atol=1e-3)


@pytest.mark.parametrize("parts", [1, 40])
def test_matrix_shares_are_bounded_by_cores(spark, parts):
    """However many parts the rows have, no more whole matrices than cores are
    handed back, and the sum is that of all rows."""
    made = spark.sparkContext.accumulator(0)

    def share(batches):
        made.add(1)
        total = np.zeros((20, 3))
        for batch in batches:
            for k in np.asarray(batch.column(0)):
                total[k % 20] += k
        return total

    got = common.added_up(spark.range(0, 1000, 1, parts), share, (20, 3))
    assert made.value <= min(parts, spark.sparkContext.defaultParallelism)
    assert (got == np.array([[k] * 3 for k in np.arange(1000).reshape(50, 20).sum(0)])).all()


def test_groups_of_all_sizes_are_summed():
    rng = np.random.default_rng(4)
    many = np.array([1, 2, 3, 1, 64, 700, 5, 1])
    at, weight, table = rng.integers(0, 90, many.sum()), rng.random(many.sum(), np.float32), rng.random((90, 7), np.float32)
    first = np.cumsum(many) - many
    want = [(weight[a : a + n, None] * table[at[a : a + n]]).sum(0) for a, n in zip(first, many, strict=True)]
    assert np.allclose(lsi_decontam._sums(table, at, weight, first, many), want, rtol=1e-4)


def test_small_groups_take_no_product_of_their_own(monkeypatch):
    """Most buckets of a passage matrix are in a few passages only: groups of up
    to eight places are added up together, larger ones are multiplied."""
    rng = np.random.default_rng(6)
    many = np.concatenate([rng.integers(1, 9, 400), [9, 64]])
    at, weight, table = rng.integers(0, 90, many.sum()), rng.random(many.sum(), np.float32), rng.random((90, 7), np.float32)
    first = np.cumsum(many) - many
    products, matmul = [], np.matmul
    monkeypatch.setattr(lsi_decontam.np, "matmul", lambda a, b: products.append(len(a)) or matmul(a, b))
    got = lsi_decontam._sums(table, at, weight, first, many)
    assert sum(products) == 2
    want = [(weight[a : a + n, None] * table[at[a : a + n]]).sum(0) for a, n in zip(first, many, strict=True)]
    assert np.allclose(got, want, rtol=1e-4)


def test_windows_of_short_last_steps_have_their_own_words_only():
    """Texts whose last steps have fewer words: no word of the next text counts,
    and the last text's steps don't go beyond the words there are."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 300, n)) for n in (9, 16, 3, 41, 1, 23)]
    weight = rng.normal(size=(lsi_decontam.BUCKETS, 12)).astype(np.float32)
    index = lsi_decontam.Items([(k, t) for k, t in enumerate(texts)], weight, np.ones(lsi_decontam.BUCKETS), 0.8, 0.6, 0.9999)
    _, h, at = next(lsi_decontam.words_of(pa.array(texts)))
    text, item, _, _ = index.near(h, at)
    alone = {(t, k) for t, x in enumerate(texts) for _, g, ends in lsi_decontam.words_of(pa.array([x])) for k in index.near(g, ends)[1].tolist()}
    assert set(zip(text.tolist(), item.tolist(), strict=True)) == alone and (4, 4) in alone


def test_language_model_learns_from_every_row(spark, monkeypatch):
    """Far more labelled rows than any sample, and each is in every sum that the
    model is made of."""
    docs = spark.range(0, 2600, 1, 3).selectExpr("id as doc_id", "if(id % 13 = 0, concat('uvw xyz ', id), concat('abc def ', id)) as text", "if(id % 13 = 0, 'b', 'a') as lang")
    seen, add = [], langid_ecoc.added_up
    monkeypatch.setattr(langid_ecoc, "added_up", lambda rows, share, shape: seen.append(rows.count()) or add(rows, share, shape))
    model = langid_ecoc.train(docs, steps=3)
    assert seen == [2600] * 4
    got = {r["doc_id"]: r["lang_pred"] for r in langid_ecoc.identify(docs, model).collect()}
    assert all(got[d] == ("b" if d % 13 == 0 else "a") for d in range(2600))


def test_parts_are_remembered_as_the_words_that_they_are():
    """A word of letters and the same letters beside signs are tokenised once,
    and the ids are the tokenizer's."""
    words = packing_cg.Words(vocabulary_path(), "<u4")
    for text in ["wordx wordx, 'wordx' wordx.", "ñandúx ñandúx!! it's it 's", "²x x² a1b ½"]:
        assert words.ids(text) == words.whole(text)
    assert {"wordx", "wordx,", ",", "ñandúx", "ñandúx!!", "!!"} <= set(words)
