"""Record-level deduplication queries (people, lineitem, events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.functions.keys import normalize_columns, normalized
from twinsift.functions.similarity import edit_distance
from twinsift.operators import exact, groups, reports, survivors
from twinsift.operators.people import make_people
from twinsift.registry import register
from twinsift.registry.sqltext import (
    EVENTS_COLUMNS,
    LINEITEM_COLUMNS,
    PEOPLE_COLUMNS,
    keep_one_sql,
    norm,
    with_people,
)
from twinsift.sources.tables import load

LINE_KEYS = ["l_orderkey", "l_linenumber"]
P = list(PEOPLE_COLUMNS)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_people(spark, load(spark, sf_dir, "customer"))


def events_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Existing / new halves of ``events``: the stable stand-in for a random
    70/30 split (ids ending in 0-6 exist already). Together they are the
    whole table."""
    ev = load(spark, sf_dir, "events")
    return ev.filter(F.col("event_id") % 10 < 7), ev.filter(F.col("event_id") % 10 >= 7)


@register("people", with_people("SELECT id, name, email, address FROM people"))
def q_people(spark, sf_dir):
    return people(spark, sf_dir)


@register("keep_first", keep_one_sql("lineitem", LINEITEM_COLUMNS, LINE_KEYS, ["l_shipdate"], "first"))
def q_keep_first(spark, sf_dir):
    return survivors.keep_one(load(spark, sf_dir, "lineitem"), LINE_KEYS, order_by=["l_shipdate"], keep="first")


@register("keep_last", keep_one_sql("lineitem", LINEITEM_COLUMNS, LINE_KEYS, ["l_shipdate"], "last"))
def q_keep_last(spark, sf_dir):
    return survivors.keep_one(load(spark, sf_dir, "lineitem"), LINE_KEYS, order_by=["l_shipdate"], keep="last")


@register("partitioned_dedup", keep_one_sql("lineitem", LINEITEM_COLUMNS, LINE_KEYS))
def q_partitioned_dedup(spark, sf_dir):
    return exact.partitioned_dedup(load(spark, sf_dir, "lineitem"), LINE_KEYS, num_partitions=100)


@register("exact_all", with_people("SELECT DISTINCT id, name, email, address FROM people"))
def q_exact_all(spark, sf_dir):
    return exact.exact_dedup(people(spark, sf_dir))


@register("exact_keys", with_people(keep_one_sql("people", P, ["name", "email"])))
def q_exact_keys(spark, sf_dir):
    return exact.exact_dedup(people(spark, sf_dir), ["name", "email"])


@register("exact_one_key", with_people(keep_one_sql("people", P, ["email"])))
def q_exact_one_key(spark, sf_dir):
    return exact.exact_dedup(people(spark, sf_dir), ["email"])


@register(
    "normalized_dedup",
    with_people(keep_one_sql("people", P, [norm("name"), norm("email")], tie_exclude=[])),
)
def q_normalized_dedup(spark, sf_dir):
    return exact.normalized_dedup(people(spark, sf_dir), ["name", "email"])


@register(
    "normalized_dedup_3",
    with_people(keep_one_sql("people", P, [norm("name"), norm("email"), norm("address")], tie_exclude=[])),
)
def q_normalized_dedup_3(spark, sf_dir):
    return exact.normalized_dedup(people(spark, sf_dir), ["name", "email", "address"])


@register(
    "normalize_columns",
    with_people(
        "SELECT id, name, email, address, "
        + ", ".join(f"{norm(c)} AS {c}_normalized" for c in ("name", "email", "address"))
        + " FROM people"
    ),
)
def q_normalize_columns(spark, sf_dir):
    return normalize_columns(people(spark, sf_dir))


@register(
    "normalize_keep_nulls",
    with_people(
        "SELECT id, name, email, address, "
        + ", ".join(f"trim(lower({c})) AS {c}_normalized" for c in ("name", "email", "address"))
        + " FROM people"
    ),
)
def q_normalize_keep_nulls(spark, sf_dir):
    return normalize_columns(people(spark, sf_dir), steps=("lower", "trim"))


FILL = {"email": "unknown@example.com", "address": "unknown"}


@register(
    "fillna_dedup",
    with_people(
        keep_one_sql(
            f"(SELECT id, name, coalesce(email, '{FILL['email']}') AS email, "
            f"coalesce(address, '{FILL['address']}') AS address FROM people)",
            P,
            ["name", "email"],
        )
    ),
)
def q_fillna_dedup(spark, sf_dir):
    return exact.fillna_dedup(people(spark, sf_dir), FILL, ["name", "email"])


@register("drop_null_keys", with_people("SELECT * FROM people WHERE name IS NOT NULL AND email IS NOT NULL"))
def q_drop_null_keys(spark, sf_dir):
    return exact.drop_null_keys(people(spark, sf_dir), ["name", "email"])


@register(
    "repeated_rows",
    with_people(
        "SELECT id, name, email, address FROM (SELECT *, row_number() OVER "
        "(PARTITION BY id, name, email, address ORDER BY id) AS __rn FROM people) WHERE __rn > 1"
    ),
)
def q_repeated_rows(spark, sf_dir):
    return survivors.repeats(people(spark, sf_dir), P)


@register(
    "duplicate_keys",
    with_people("SELECT name, email, count(*) AS count FROM people GROUP BY name, email HAVING count(*) >= 2"),
)
def q_duplicate_keys(spark, sf_dir):
    return groups.duplicate_keys(people(spark, sf_dir), ["name", "email"])


@register(
    "latest_wins",
    keep_one_sql("events", EVENTS_COLUMNS, ["user_id", "event_type"], ["ts"], "last"),
)
def q_latest_wins(spark, sf_dir):
    existing, new = events_split(spark, sf_dir)
    return survivors.latest_wins(existing, new, ["user_id", "event_type"], "ts")


_LEN = " + ".join(f"coalesce(length({c}), 0)" for c in ("name", "email", "address"))
_NN = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ("name", "email", "address"))


@register(
    "keep_most_complete",
    with_people(
        keep_one_sql(
            "people",
            P,
            [norm("name"), norm("email")],
            [f"({_NN})", f"({_LEN})", "id"],
            keep="last",
            tie_exclude=[],
        )
    ),
)
def q_keep_most_complete(spark, sf_dir):
    df = people(spark, sf_dir)
    return survivors.keep_most_complete(df, [normalized("name"), normalized("email")], id_col="id")


@register(
    "merge_records",
    "SELECT user_id, event_type, "
    + ", ".join(
        f"first({c} ORDER BY ts ASC NULLS FIRST, {c} ASC) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("event_id", "ts", "value", "props")
    )
    + " FROM events GROUP BY user_id, event_type",
)
def q_merge_records(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(*EVENTS_COLUMNS)
    return survivors.merge_records(ev, ["user_id", "event_type"], order_by="ts").select(
        "user_id", "event_type", "event_id", "ts", "value", "props"
    )


@register(
    "checksum_md5",
    with_people(
        keep_one_sql(
            "people", P,
            ["md5(concat_ws('|', coalesce(name, ''), coalesce(email, ''), coalesce(address, '')))"],
            tie_exclude=[],
        )
    ),
)
def q_checksum_md5(spark, sf_dir):
    return exact.fingerprint_dedup(people(spark, sf_dir), ["name", "email", "address"], "md5")


@register(
    "checksum_sha256",
    with_people(
        keep_one_sql(
            "people", P,
            ["sha256(concat_ws('|', coalesce(name, ''), coalesce(email, ''), coalesce(address, '')))"],
            tie_exclude=[],
        )
    ),
)
def q_checksum_sha256(spark, sf_dir):
    return exact.fingerprint_dedup(people(spark, sf_dir), ["name", "email", "address"], "sha256")


@register(
    "spark_hash",
    with_people(keep_one_sql("people", P, ["md5(concat_ws('|', name, email, address))"], tie_exclude=[])),
)
def q_spark_hash(spark, sf_dir):
    return exact.fingerprint_dedup(people(spark, sf_dir), ["name", "email", "address"], "concat_md5")


@register("hash64_verified", with_people(keep_one_sql("people", P, ["name", "email", "address"], tie_exclude=[])))
def q_hash64_verified(spark, sf_dir):
    return exact.fingerprint_dedup(people(spark, sf_dir), ["name", "email", "address"], "xxhash64")


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@register("late_dedup_documents", keep_one_sql("documents", DOCUMENT_COLUMNS, ["text"], ["doc_id"]))
def q_late_dedup_documents(spark, sf_dir):
    """One document of each text: only documents whose text comes again are
    shuffled with it."""
    return exact.late_dedup(load(spark, sf_dir, "documents"), ["text"], order_by=["doc_id"])


@register("late_dedup_rows", "SELECT DISTINCT * FROM lineitem")
def q_late_dedup_rows(spark, sf_dir):
    return exact.late_dedup(load(spark, sf_dir, "lineitem"))


@register(
    "json_fingerprint",
    with_people(keep_one_sql("people", P, ["md5(to_json([name, email, address]))"], tie_exclude=[])),
)
def q_json_fingerprint(spark, sf_dir):
    return exact.fingerprint_dedup(people(spark, sf_dir), ["name", "email", "address"], "json_md5")


@register(
    "edit_distance",
    "SELECT p_partkey, p_name, p_type, CAST(levenshtein(p_name, p_type) AS BIGINT) AS distance FROM part",
)
def q_edit_distance(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name", "p_type", edit_distance("p_name", "p_type").cast("bigint").alias("distance"))


@register(
    "dedup_report",
    with_people(
        "SELECT (SELECT count(*) FROM people) AS original_count, "
        "CAST((SELECT sum(c) FROM g) AS BIGINT) AS deduplicated_count, "
        "(SELECT count(*) FROM people) - CAST((SELECT sum(c) FROM g) AS BIGINT) AS duplicates_removed, "
        "round(((SELECT count(*) FROM people) - (SELECT sum(c) FROM g)) * 100.0 / (SELECT count(*) FROM people), 4) "
        "AS dedup_rate, "
        "(SELECT count(*) FROM g WHERE c > 1) AS remaining_duplicate_groups",
        ", d AS (" + keep_one_sql("people", P, ["name", "email"]) + "), "
        "g AS (SELECT name, email, count(*) AS c FROM d GROUP BY name, email)",
    ),
)
def q_dedup_report(spark, sf_dir):
    df = people(spark, sf_dir)
    return reports.dedup_report(df, exact.exact_dedup(df, ["name", "email"]), ["name", "email"])


@register(
    "duplicate_overview",
    with_people(
        "SELECT CAST(sum(c) AS BIGINT) AS total_rows, count(*) AS unique_keys, "
        "CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows, "
        "round((sum(c) - count(*)) * 100.0 / sum(c), 4) AS duplicate_rate "
        "FROM (SELECT name, email, count(*) AS c FROM people GROUP BY name, email)"
    ),
)
def q_duplicate_overview(spark, sf_dir):
    return reports.duplicate_overview(people(spark, sf_dir), ["name", "email"])


@register(
    "array_key_dedup",
    keep_one_sql("embeddings", ("vec_id", "embedding", "label"), ["embedding"], ["vec_id"]),
)
def q_array_key_dedup(spark, sf_dir):
    """Deduplication keyed by an array<float> column (first by vec_id)."""
    return survivors.keep_one(load(spark, sf_dir, "embeddings"), ["embedding"], order_by=["vec_id"])


@register("no_duplicates_pages", keep_one_sql("pages", ("page_id", "url", "html"), ["url"], ["page_id"]))
def q_no_duplicates_pages(spark, sf_dir):
    """Raw pages keyed by URL: an input without repeats comes back whole."""
    return exact.exact_dedup(load(spark, sf_dir, "pages"), ["url"], order_by=["page_id"])


@register(
    "sampled_overview",
    "SELECT CAST(sum(c) AS BIGINT) AS total_rows, count(*) AS unique_keys, "
    "CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows, "
    "round((sum(c) - count(*)) * 100.0 / sum(c), 4) AS duplicate_rate "
    f"FROM (SELECT {', '.join(LINE_KEYS)}, count(*) AS c FROM lineitem WHERE CAST('0x' || substr(md5(concat_ws('|', '42', "
    + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in LINE_KEYS)
    + f")), 1, 8) AS BIGINT) % 10000 < 1000 GROUP BY {', '.join(LINE_KEYS)})",
)
def q_sampled_overview(spark, sf_dir):
    """Duplicate overview of a tenth of lineitem's keys, with all their rows
    (sampling is the query's feature)."""
    return reports.sampled_overview(load(spark, sf_dir, "lineitem"), LINE_KEYS, 0.1, 42)


@register(
    "sampled_rate",
    with_people(
        "SELECT m AS sampled_keys, CAST(x AS BIGINT) AS sampled_rows, round(100 * r, 4) AS duplicate_rate, "
        "round(100 * least(1, e), 4) AS standard_error, round(100 * greatest(0, r - 1.96 * e), 4) AS low, "
        "round(100 * least(1, r + 1.96 * e), 4) AS high, CAST(round((x - m) / 0.2) AS BIGINT) AS expected_duplicates "
        "FROM (SELECT m, x, r, sqrt(0.8 * greatest(0, xx * (1 - r) * (1 - r) - 2 * (1 - r) * x + m)) / x AS e "
        "FROM (SELECT *, (x - m) / x AS r FROM (SELECT count(*) AS m, CAST(sum(n) AS DOUBLE) AS x, CAST(sum(n * n) AS DOUBLE) AS xx "
        "FROM (SELECT email, count(*) AS n FROM people WHERE CAST('0x' || substr(md5('42|' || coalesce(email, '')), 1, 8) AS BIGINT) "
        "% 10000 < 2000 GROUP BY email))))"
    ),
)
def q_sampled_rate(spark, sf_dir):
    """The duplicate rate by e-mail with its 95 % interval, from a fifth of the
    keys (sampling is the query's feature)."""
    return reports.duplicate_rate_interval(people(spark, sf_dir), ["email"], 0.2)


@register(
    "key_quality",
    with_people(
        " UNION ALL ".join(
            f"SELECT (SELECT count(*) FROM people) AS rows, '{c}' AS column_name, "
            f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
            f"CAST(count_if(trim({c}) = '') AS BIGINT) AS blank_count FROM people"
            for c in ("name", "email", "address")
        )
    ),
)
def q_key_quality(spark, sf_dir):
    return reports.key_quality(people(spark, sf_dir), ["name", "email", "address"])


@register(
    "distinct_counts",
    with_people(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM people)) AS distinct_count"
            for c in ("id", "name", "email", "address")
        )
    ),
)
def q_distinct_counts(spark, sf_dir):
    return reports.distinct_counts(people(spark, sf_dir), ["id", "name", "email", "address"])
