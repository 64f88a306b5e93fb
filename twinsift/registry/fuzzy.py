"""Similarity queries: edit distance and ratio pairs of distinct values,
token-set Jaccard and MinHash LSH, entity clusters and fuzzy dedup.

The oracles compare every pair of distinct values (fine for a check at
small scale); the Spark jobs never do: they block exactly (see
``operators.fuzzy``) or by prefix filtering (``operators.minhash``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from twinsift.functions.keys import digest_bucket, normalized
from twinsift.operators import clusters, fuzzy, minhash
from twinsift.operators.labels import LabelStore
from twinsift.plans.methods import METHODS, compare_methods
from twinsift.registry import register
from twinsift.registry.records import people
from twinsift.registry.sqltext import PEOPLE_COLUMNS, keep_one_sql, norm, with_people
from twinsift.session import scratch_path
from twinsift.sources.tables import load

T = 2


def _edit_sql(values_sql: str, t: int = T, column: str | None = None) -> str:
    col = f"'{column}' AS column_name, " if column else ""
    return (
        f"SELECT {col}a.v AS value_a, b.v AS value_b, CAST(levenshtein(a.v, b.v) AS BIGINT) AS distance "
        f"FROM ({values_sql}) a JOIN ({values_sql}) b ON a.v < b.v "
        f"AND abs(length(a.v) - length(b.v)) <= {t} WHERE levenshtein(a.v, b.v) <= {t}"
    )


@register("levenshtein_names", _edit_sql("SELECT DISTINCT p_name AS v FROM part WHERE p_name IS NOT NULL"))
def q_levenshtein_names(spark, sf_dir):
    return fuzzy.edit_pairs(load(spark, sf_dir, "part").select("p_name"), T)


_NAMES_SQL = _edit_sql("SELECT DISTINCT p_name AS v FROM part WHERE p_name IS NOT NULL")


@register(
    "levenshtein_names_both",
    f"WITH e AS ({_NAMES_SQL}) SELECT value_a, value_b, distance FROM e UNION ALL SELECT value_b, value_a, distance FROM e",
)
def q_levenshtein_names_both(spark, sf_dir):
    """Each near pair of part names in both orientations."""
    return fuzzy.both_orientations(fuzzy.edit_pairs(load(spark, sf_dir, "part").select("p_name"), T))


@register(
    "levenshtein_pairs",
    with_people(
        _edit_sql(f"SELECT DISTINCT {norm('name')} AS v FROM people", column="name")
        + " UNION ALL "
        + _edit_sql(f"SELECT DISTINCT {norm('email')} AS v FROM people", column="email")
    ),
)
def q_levenshtein_pairs(spark, sf_dir):
    """Normalised name or email values within 2 edits, per column."""
    return fuzzy.column_edit_pairs(people(spark, sf_dir), ["name", "email"], T, key=normalized)


_LCS_SQL = (
    "list_reduce(range(1, length(a) + 1), lambda row, i: list_prepend(0, list_transform(range(1, length(b) + 1), "
    "lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(row[k + 1], CASE WHEN "
    "substr(a, CAST(i AS INTEGER), 1) = substr(b, CAST(k AS INTEGER), 1) THEN row[k] + 1 ELSE 0 END))))), "
    "list_transform(range(0, length(b) + 1), lambda x: 0))[length(b) + 1]"
)
_RATIO_SQL = (
    "CASE WHEN a = b THEN 100 WHEN length(a) = 0 OR length(b) = 0 THEN 0 "
    f"ELSE CAST(round_even(200.0 * ({_LCS_SQL}) / (length(a) + length(b)), 0) AS BIGINT) END"
)


@register(
    "ratio_pairs",
    "WITH v AS (SELECT DISTINCT p_name AS s FROM part WHERE p_name IS NOT NULL), "
    "c AS (SELECT x.s AS a, y.s AS b FROM v x JOIN v y ON x.s < y.s "
    "AND abs(length(x.s) - length(y.s)) <= (length(x.s) + length(y.s)) * 0.155), "
    f"r AS (SELECT a, b, {_RATIO_SQL} AS ratio FROM c) "
    "SELECT a AS value_a, b AS value_b, ratio FROM r WHERE ratio >= 85",
)
def q_ratio_pairs(spark, sf_dir):
    """Distinct part names with similarity ratio >= 85."""
    return fuzzy.ratio_pairs(load(spark, sf_dir, "part").select("p_name"), 85)


_SETS_SQL = (
    "WITH s0 AS (SELECT DISTINCT list_sort(list_distinct(list_filter(string_split_regex(lower(text), '\\s+'), "
    "lambda x: x <> ''))) AS toks FROM documents WHERE text IS NOT NULL), "
    "s AS (SELECT md5(array_to_string(toks, ' ')) AS set_id, toks, len(toks) AS n FROM s0 WHERE len(toks) > 0), "
    "p AS (SELECT a.set_id AS set_a, b.set_id AS set_b, "
    "len(list_intersect(a.toks, b.toks)) / len(list_distinct(list_concat(a.toks, b.toks))) AS j "
    "FROM s a JOIN s b ON a.set_id < b.set_id AND b.n >= a.n * {s} - 1e-9 AND a.n >= b.n * {s} - 1e-9)\n"
)


@register(
    "jaccard_documents",
    _SETS_SQL.format(s=0.7) + "SELECT set_a, set_b, round(j, 6) AS similarity FROM p WHERE j >= 0.7 - 1e-9",
)
def q_jaccard_documents(spark, sf_dir):
    sets = minhash.materialized_token_sets(load(spark, sf_dir, "documents"), "text")
    return minhash.jaccard_pairs(sets, 0.7).withColumn("similarity", F.round("similarity", 6))


@register(
    "lsh_pairs",
    _SETS_SQL.format(s=0.7) + "SELECT set_a, set_b, round(1 - j, 6) AS distance FROM p WHERE 1 - j < 0.3 - 1e-9",
)
def q_lsh_pairs(spark, sf_dir):
    """Banded MinHash LSH (32 bands x 4 rows, fixed seed) on document token
    sets, candidates re-checked by exact Jaccard: distance < 0.3."""
    sets = minhash.materialized_token_sets(load(spark, sf_dir, "documents"), "text")
    return minhash.minhash_pairs(sets, 0.3).withColumn("distance", F.round("distance", 6))


@register("lsh_documents")
def q_lsh_documents(spark, sf_dir):
    """Raw LSH output as configured in the published method: 1024 hashed
    features, distance on hashed vectors, no re-check."""
    sets = minhash.materialized_token_sets(load(spark, sf_dir, "documents"), "text")
    return minhash.mllib_lsh_pairs(sets, 0.3, num_features=1024, verify=False)


def _exact_pairs(sets):
    return minhash.jaccard_pairs(sets, 0.7).filter(F.col("similarity") > 0.7 + minhash.EPS)


@register("lsh_recall")
def q_lsh_recall(spark, sf_dir):
    """MLlib LSH (published configuration) and banded MinHash against the exact
    Jaccard join on document token sets (distance < 0.3): pairs found, right
    ones, recall and precision. What MLlib finds follows from its hashes, so
    there is no SQL for it."""
    sets = minhash.materialized_token_sets(load(spark, sf_dir, "documents"), "text")
    found = {
        "mllib_lsh_1024": minhash.mllib_lsh_pairs(sets, 0.3, num_features=1024, verify=False),
        "banded_minhash": minhash.minhash_pairs(sets, 0.3),
    }
    return minhash.recall_report(_exact_pairs(sets), found)


@register(
    "lsh_recall_banded",
    _SETS_SQL.format(s=0.7)
    + "SELECT 'banded_minhash' AS method, n AS exact_pairs, n AS found_pairs, n AS true_pairs, "
    "CASE WHEN n > 0 THEN 1.0::DOUBLE END AS recall, CASE WHEN n > 0 THEN 1.0::DOUBLE END AS precision "
    "FROM (SELECT count(*) AS n FROM p WHERE 1 - j < 0.3 - 1e-9)",
)
def q_lsh_recall_banded(spark, sf_dir):
    """Banded MinHash against the exact Jaccard join, the whole report: it finds
    the exact pair set (a pair of similarity 0.7 is missed once in 3,000)."""
    sets = minhash.materialized_token_sets(load(spark, sf_dir, "documents"), "text")
    return minhash.recall_report(_exact_pairs(sets), {"banded_minhash": minhash.minhash_pairs(sets, 0.3)})


_GRAPH_CTES = (
    ", np AS (SELECT id, " + norm("name") + " AS nn, " + norm("email") + " AS ne FROM people)"
    ", pn AS (" + _edit_sql("SELECT DISTINCT nn AS v FROM np WHERE nn <> ''") + ")"
    ", pe AS (" + _edit_sql("SELECT DISTINCT ne AS v FROM np WHERE ne <> ''") + ")"
    ", e AS (SELECT 'r:' || id AS s, 'r:' || id AS d FROM np UNION SELECT 'r:' || id, 'n:' || nn FROM np WHERE nn <> '' "
    "UNION SELECT 'r:' || id, 'e:' || ne FROM np WHERE ne <> '' "
    "UNION SELECT 'n:' || value_a, 'n:' || value_b FROM pn UNION SELECT 'e:' || value_a, 'e:' || value_b FROM pe)"
    ", u AS (SELECT s, d FROM e UNION SELECT d, s FROM e)"
    ", lab AS (SELECT node, min(label) AS comp FROM ("
    "WITH RECURSIVE r(node, label) AS (SELECT s, s FROM u UNION SELECT u.d, r.label FROM r JOIN u ON u.s = r.node "
    "WHERE r.label < u.d) SELECT * FROM r) GROUP BY node)"
    ", rows AS (SELECT substr(node, 3) AS id, comp FROM lab WHERE node LIKE 'r:%')"
    ", cl AS (SELECT r.id, m.cluster_id FROM rows r JOIN (SELECT comp, min(id) AS cluster_id FROM rows GROUP BY comp) m "
    "ON r.comp = m.comp)"
)


@register("fuzzy_clusters", with_people("SELECT id, cluster_id FROM cl", _GRAPH_CTES))
def q_fuzzy_clusters(spark, sf_dir):
    """Rows linked by equal or near (<= 2 edits) normalised name or email."""
    return clusters.entity_clusters(people(spark, sf_dir), ["name", "email"], "id", "fuzzy_levenshtein", T)


@register(
    "fuzzy_dedup",
    with_people(
        keep_one_sql(
            "(SELECT p.*, cl.cluster_id FROM people p JOIN cl ON p.id = cl.id)",
            PEOPLE_COLUMNS,
            ["cluster_id"],
            ["id"],
        ),
        _GRAPH_CTES,
    ),
)
def q_fuzzy_dedup(spark, sf_dir):
    return clusters.resolve_entities(people(spark, sf_dir), "fuzzy_levenshtein", ["name", "email"], "id", T)


@register(
    "components_by_batches",
    with_people(
        "SELECT node, min(label) AS component FROM (WITH RECURSIVE r(node, label) AS (SELECT s, s FROM u UNION "
        "SELECT u.d, r.label FROM r JOIN u ON u.s = r.node WHERE r.label < u.d) SELECT * FROM r) GROUP BY node",
        ", e AS (SELECT DISTINCT 'n:' || name AS s, 'e:' || email AS d FROM people WHERE name IS NOT NULL AND email IS NOT NULL)"
        ", u AS (SELECT s, d FROM e UNION SELECT d, s FROM e UNION SELECT s, s FROM e UNION SELECT d, d FROM e)",
    ),
)
def q_components_by_batches(spark, sf_dir):
    """Names and e-mails that people link, arriving in four batches: the stored
    labels after the last one are those of the whole graph."""
    rows = people(spark, sf_dir).where("name is not null and email is not null")
    store = LabelStore(spark, scratch_path(spark, "labels"))
    for batch in range(4):
        part = rows.where(digest_bucket("id", 4) == batch)
        store.add(part.select(F.concat(F.lit("n:"), "name").alias("src"), F.concat(F.lit("e:"), "email").alias("dst")), batch)
    return store.current()


def _method_sql() -> str:
    """Oracle of the comparison table: the ten methods' unique counts."""
    n_norm = f"(SELECT count(*) FROM (SELECT DISTINCT {norm('name')}, {norm('email')} FROM people))"
    ne = "(SELECT count(*) FROM (SELECT DISTINCT name, email FROM people))"
    nh = "(SELECT count(*) FROM (SELECT DISTINCT md5(concat_ws('|', coalesce(name, ''), coalesce(email, ''), coalesce(address, ''))) FROM people))"
    ns = "(SELECT count(*) FROM (SELECT DISTINCT sha256(concat_ws('|', coalesce(name, ''), coalesce(email, ''), coalesce(address, ''))) FROM people))"
    nc = "(SELECT count(*) FROM (SELECT DISTINCT md5(concat_ws('|', name, email, address)) FROM people))"
    per = {
        "exact": ne, "window": ne, "normalized": n_norm, "fuzzy_levenshtein": ne, "fuzzy_fuzzywuzzy": ne,
        "lsh": ne, "checksum_md5": nh, "checksum_sha256": ns, "spark_hash": nc, "partitioned_hash": ne,
    }
    rows = " UNION ALL ".join(f"SELECT '{m}' AS method, {per[m]} AS unique_count" for m in METHODS)
    return with_people(
        "SELECT method, (SELECT count(*) FROM people) AS original_count, unique_count, "
        "(SELECT count(*) FROM people) - unique_count AS duplicates_removed, "
        "round(((SELECT count(*) FROM people) - unique_count) * 100.0 / (SELECT count(*) FROM people), 4) AS dedup_rate "
        f"FROM ({rows})"
    )


@register("method_comparison", _method_sql())
def q_method_comparison(spark, sf_dir):
    return compare_methods(people(spark, sf_dir))
