"""Similarity joins against brute force, components against union-find."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import ids
from twinsift.functions.similarity import lcs_length, ratio_value
from twinsift.operators import clusters, fuzzy, minhash


def lev(a: str, b: str) -> int:
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def lcs_dp(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def random_values(seed: int, n: int = 300, alphabet: str = "abcd") -> list[str]:
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(n // 2)]
    out = set(base)
    for s in base:
        t = list(s)
        for _ in range(rng.randint(0, 3)):
            op = rng.random()
            if op < 0.33 and t:
                t.pop(rng.randrange(len(t)))
            elif op < 0.66:
                t.insert(rng.randrange(len(t) + 1), rng.choice(alphabet))
            elif t:
                t[rng.randrange(len(t))] = rng.choice(alphabet)
        out.add("".join(t))
    return sorted(out)


def test_lcs_bit_parallel_matches_dp():
    rng = random.Random(1)
    for _ in range(500):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        assert lcs_length(a, b) == lcs_dp(a, b)


def test_ratio_rules():
    assert ratio_value("abc", "abc") == 100 and ratio_value("", "") == 100
    assert ratio_value("", "a") == 0 and ratio_value(None, "a") == 0
    assert ratio_value("abcd", "abce") == 75


@pytest.mark.parametrize("t", [1, 2, 3])
def test_blocked_edit_pairs_equal_brute_force(spark, t):
    vals = random_values(t)
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {(r.value_a, r.value_b, r.distance) for r in fuzzy.edit_pairs(df, t).collect()}
    want = {(a, b, lev(a, b)) for i, a in enumerate(vals) for b in vals[i + 1 :] if lev(a, b) <= t}
    assert got == want


def test_blocked_edit_pairs_unicode_equal_brute_force(spark):
    vals = random_values(99, n=200, alphabet="aé日😀")
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {(r.value_a, r.value_b, r.distance) for r in fuzzy.edit_pairs(df, 2).collect()}
    want = {(a, b, lev(a, b)) for i, a in enumerate(vals) for b in vals[i + 1 :] if lev(a, b) <= 2}
    assert got == want


@pytest.mark.parametrize("thr", [70, 85])
def test_blocked_ratio_pairs_equal_brute_force(spark, thr):
    vals = random_values(10 + thr)
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {(r.value_a, r.value_b, r.ratio) for r in fuzzy.ratio_pairs(df, thr).collect()}
    want = {(a, b, ratio_value(a, b)) for i, a in enumerate(vals) for b in vals[i + 1 :] if ratio_value(a, b) >= thr}
    assert got == want


def test_edit_pairs_plan_has_no_cartesian_product(spark):
    df = spark.createDataFrame([("abc",), ("abd",)], "v string")
    plan = fuzzy.edit_pairs(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_connected_components_equal_union_find(spark):
    rng = random.Random(5)
    n = 400
    edges = [(f"n{rng.randrange(n):04d}", f"n{rng.randrange(n):04d}") for _ in range(300)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups: dict[str, list[str]] = {}
    for x in list(parent):
        groups.setdefault(find(x), []).append(x)
    want = {x: min(g) for g in groups.values() for x in g}
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.component for r in clusters.connected_components(df).collect()}
    assert got == want


def test_entity_clusters_on_sample(sample):
    got = {r.id: r.cluster_id for r in clusters.entity_clusters(sample).collect()}
    assert got == {"ID1": "ID1", "ID2": "ID1", "ID4": "ID1", "ID5": "ID1", "ID3": "ID3", "ID6": "ID6"}


def test_missing_values_link_nobody(spark):
    rows = [("1", "Ann Ode", None), ("2", "Bob Elm", ""), ("3", "Cyd Fir", "  "), ("4", None, None), ("5", "", None), ("6", None, "c@x.org"), ("7", "Cyd Fir", "c@x.org")]
    df = spark.createDataFrame(rows, "id string, name string, email string")
    got = {r.id: r.cluster_id for r in clusters.entity_clusters(df).collect()}
    assert got == {"1": "1", "2": "2", "3": "3", "4": "4", "5": "5", "6": "3", "7": "3"}
    three = df.withColumn("phone", F.when(F.col("id").isin("1", "4"), "555"))
    assert {r.id: r.cluster_id for r in clusters.entity_clusters(three, ["name", "email", "phone"]).collect()}["4"] == "1"


def test_single_column_clusters(sample):
    got = {r.id: r.cluster_id for r in clusters.entity_clusters(sample, ["email"]).collect()}
    assert got == {"ID1": "ID1", "ID2": "ID1", "ID4": "ID1", "ID5": "ID1", "ID3": "ID3", "ID6": "ID6"}
    alone = {r.id: r.cluster_id for r in clusters.entity_clusters(sample, ["address"], threshold=0).collect()}
    assert alone["ID3"] == "ID3" and alone["ID6"] == "ID6" and alone["ID2"] == "ID1"


def test_resolve_by_ratio_and_token_sets(sample):
    assert ids(clusters.resolve_entities(sample, "fuzzy_fuzzywuzzy", threshold=85)) == ["ID1", "ID3", "ID6"]
    # at 80 the mail addresses of one domain are near: all are one cluster
    assert ids(clusters.resolve_entities(sample, "fuzzy_fuzzywuzzy", threshold=80)) == ["ID1"]
    assert ids(clusters.resolve_entities(sample, "lsh", threshold=0.3)) == ["ID1", "ID3", "ID6"]


def _sets(spark, texts):
    return minhash.token_sets(spark.createDataFrame([(t,) for t in texts], "text string"), "text")


def test_exact_jaccard_equals_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.sample(words, rng.randint(1, 12))) for _ in range(200)]
    sets = _sets(spark, texts)
    rows = {r.set_id: set(r.tokens) for r in sets.collect()}
    for s in (0.5, 0.7):
        got = {(r.set_a, r.set_b) for r in minhash.jaccard_pairs(sets, s).collect()}
        keys = sorted(rows)
        want = {
            (a, b)
            for i, a in enumerate(keys)
            for b in keys[i + 1 :]
            if len(rows[a] & rows[b]) / len(rows[a] | rows[b]) >= s - 1e-9
        }
        assert got == want


def test_lsh_pairs_are_exact_and_find_near_copies(spark):
    base = "the quick brown fox jumps over the lazy dog again and again today"
    texts = [base, base + " now", "completely different words here", base.replace("lazy", "sleepy")]
    sets = _sets(spark, texts)
    for pairs in (minhash.mllib_lsh_pairs(sets, 0.3).collect(), minhash.minhash_pairs(sets, 0.3).collect()):
        assert len(pairs) == 3 and all(p.distance < 0.3 for p in pairs)


def test_labels_grow_batch_by_batch(spark, tmp_path):
    """After each batch the stored labels are those of a full run, a batch that
    comes again changes nothing, and only joined components are written."""
    import random

    from twinsift.operators.clusters import connected_components
    from twinsift.operators.labels import LabelStore

    rng = random.Random(12)
    name = lambda: f"n{rng.randrange(160):03d}"
    batches = [[(name(), name()) for _ in range(40)] for _ in range(4)]
    batches[1] += [("n500", "n500"), (None, "n1"), ("n501", "n502"), ("n501", "n502")]
    batches[3] += [("n502", "n000")]
    store, seen = LabelStore(spark, f"{tmp_path}/labels"), []
    before: dict = {}
    for k, batch in enumerate(batches):
        edges = spark.createDataFrame(batch, "src string, dst string")
        seen += batch
        written = store.add(edges, k)
        if k == 1:
            assert store.add(edges, k) == written  # again
        now = {r.node: r.component for r in store.current().collect()}
        full = connected_components(spark.createDataFrame(seen, "src string, dst string"))
        assert now == {r.node: r.component for r in full.collect()}
        assert written == sum(before.get(n) != c for n, c in now.items())
        before = now
    assert {r.node: r.component for r in store.compact(f"{tmp_path}/one").current().collect()} == before
    assert LabelStore(spark, f"{tmp_path}/one").add(spark.createDataFrame([("n500", "n000")], "src string, dst string"), 4) == 1


def _near_copies(rng, n=160):
    """Texts over one vocabulary: unrelated ones, near copies, sets of one token, sizes from 1 to 300."""
    words = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(n):
        base = rng.sample(words, rng.choice([1, 3, 12, 60, 300]))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 2)):
            texts.append(" ".join(w if rng.random() > 0.15 else rng.choice(words) for w in base))
    return texts


def _jaccards(rows):
    keys = sorted(rows)
    return {(a, b): len(rows[a] & rows[b]) / len(rows[a] | rows[b]) for i, a in enumerate(keys) for b in keys[i + 1 :]}


def test_unlike_sets_are_dropped_before_their_tokens_travel(spark):
    sets = _sets(spark, _near_copies(random.Random(21))).cache()
    near = _jaccards({r.set_id: set(r.tokens) for r in sets.collect()})
    want = {p for p, j in near.items() if j >= 0.7 - 1e-9}
    # one hash a band: every pair with anything in common is met
    loose = {(r.set_a, r.set_b) for r in minhash.banded_candidates(sets, 32, 1).collect()}
    got = {(r.set_a, r.set_b) for r in minhash.banded_candidates(sets, 32, 1, min_similarity=0.7).collect()}
    assert want <= got <= loose and len(got) < len(want) + 0.02 * len(loose)
    assert {(r.set_a, r.set_b): round(r.similarity, 12) for r in minhash.jaccard_pairs(sets, 0.7).collect()} == {p: round(near[p], 12) for p in want}
    sets.unpersist()


def test_exact_join_shuffles_no_single_tokens(spark):
    plan = minhash.jaccard_pairs(_sets(spark, ["a b c", "a b d"]), 0.7)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "explode(tokens" not in plan


def test_exact_join_in_many_parts_and_cells(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PER_PART", 9)
    monkeypatch.setattr(minhash, "PER_CELL", 5)
    sets = _sets(spark, _near_copies(random.Random(22), 80)).cache()
    near = _jaccards({r.set_id: set(r.tokens) for r in sets.collect()})
    for s in (0.4, 0.7, 1.0):
        assert {(r.set_a, r.set_b) for r in minhash.jaccard_pairs(sets, s).collect()} == {p for p, j in near.items() if j >= s - 1e-9}
    assert {(r.set_a, r.set_b) for r in minhash.minhash_pairs(sets, 0.3).collect()} <= {p for p, j in near.items() if j > 0.7}
    sets.unpersist()


def test_mllib_pairs_are_those_of_its_join(spark):
    """What approxSimilarityJoin finds, met in parts instead of its join."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, MinHashLSH

    sets = _sets(spark, _near_copies(random.Random(23), 60)).cache()
    for features in (64, 1024, 1 << 18):
        stages = [
            HashingTF(inputCol="tokens", outputCol="features", numFeatures=features),
            MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=5, seed=minhash.DEFAULT_SEED),
        ]
        model = Pipeline(stages=stages).fit(sets)
        rows = model.transform(sets)
        joined = model.stages[-1].approxSimilarityJoin(rows, rows, 0.3, distCol="d").filter("datasetA.set_id < datasetB.set_id")
        want = {(r.a, r.b, round(r.d, 12)) for r in joined.selectExpr("datasetA.set_id a", "datasetB.set_id b", "d").collect()}
        got = minhash.mllib_lsh_pairs(sets, 0.3, num_features=features, verify=False)
        assert "posexplode" not in got._jdf.queryExecution().executedPlan().toString()
        assert want and {(r.set_a, r.set_b, round(r.distance, 12)) for r in got.collect()} == want
    sets.unpersist()
