"""From similar pairs to entities: connected components, then one survivor
per component.

Components are found by alternating Large-Star and Small-Star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014):
O(log^2 n) rounds, each a few aggregates and joins. No neighbour list is
ever collected: a hub node with a third of all edges is reduced by partial
aggregation and joined with AQE's skew handling. Every round is written to
the shared checkpoint folder (``checkpoint()``, never a local one), so a lost
executor costs at most one round and lineage stays short.

The graph has VALUE nodes only: a row is an edge between its (normalised)
key values, similar values are edges too, and rows take the component of
their values at the end. A key shared by a million rows is one node, not a
million row nodes, let alone half a trillion row pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.functions.keys import normalized
from twinsift.operators.fuzzy import edit_pairs, ratio_pairs
from twinsift.operators.survivors import keep_one
from twinsift.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    nbr = _both_ways(edges)
    mins = nbr.groupBy("u").agg(F.min("v").alias("mv")).select("u", F.least("u", "mv").alias("m"))
    return (
        nbr.filter(F.col("v") > F.col("u"))
        .join(mins, "u")
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    small = _both_ways(edges).filter(F.col("v") < F.col("u"))
    mins = small.groupBy("u").agg(F.min("v").alias("m"))
    leaves = small.join(mins, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    centers = mins.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return leaves.unionByName(centers).filter(F.col("a") != F.col("b")).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Every edge points from a leaf to a root, and each leaf has one root:
    no node is a leaf twice, and no node is both a leaf and a center. One
    aggregate, one job."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("center")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("center"))
    )
    per_node = roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("center").alias("center"))
    return per_node.filter((F.col("leaf") > 1) | ((F.col("leaf") == 1) & (F.col("center") == 1))).isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` for every node of the undirected graph; the
    component is named by its smallest node."""
    # one reliable copy of the input: the node list and round 0 both read it
    base = (
        edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b"))
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        .distinct()
    )
    base = cut_lineage(base)
    nodes = base.select(F.col("a").alias("node")).unionByName(base.select(F.col("b").alias("node"))).distinct()
    e = base.filter(F.col("a") != F.col("b"))
    while True:
        e = cut_lineage(_small_star(_large_star(e)))
        if _is_star_forest(e):
            break
    labels = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


VALUE, SET, ROW = "v", "s", "r"


def _node(kind: str, *parts) -> F.Column:
    return F.concat_ws("\u0001", F.lit(kind), *parts)


def _value_node(column: str) -> F.Column:
    """The node of a row's value; NULL for a missing or blank one, which says
    nothing about whom it belongs to and so links nobody."""
    v = normalized(column)
    return F.when(v != "", _node(VALUE, F.lit(column), v))


def similarity_edges(
    df: DataFrame,
    columns: Sequence[str],
    id_col: str = "id",
    method: str = "fuzzy_levenshtein",
    threshold: float | None = None,
) -> DataFrame:
    """Graph edges ``src, dst`` over VALUE nodes: each distinct combination
    of a row's normalised values links them (a row is an edge, not a node),
    and similar values of one column link to each other. For ``lsh``
    (token-set similarity) values link to their token-set node, and similar
    sets link to each other, so equal sets never expand into value pairs."""
    edges = None
    if len(columns) > 1:
        present = F.filter(F.array(*[_value_node(c) for c in columns]), lambda n: n.isNotNull())
        steps = F.zip_with(F.slice(present, 1, F.size(present) - 1), F.slice(present, 2, F.size(present)), lambda a, b: F.struct(a.alias("src"), b.alias("dst")))
        edges = df.select(F.explode(F.when(F.size(present) > 1, steps)).alias("e")).select("e.src", "e.dst").distinct()
    for c in columns:
        values = df.select(normalized(c).alias("v")).filter("v <> ''")
        if method == "fuzzy_levenshtein":
            pairs = edit_pairs(values, int(threshold if threshold is not None else 2))
        elif method == "fuzzy_fuzzywuzzy":
            pairs = ratio_pairs(values, int(threshold if threshold is not None else 85))
        elif method == "lsh":
            pairs = None
        else:
            raise ValueError(f"unknown similarity method {method!r}")
        if pairs is not None:
            sim = pairs.select(
                _node(VALUE, F.lit(c), F.col("value_a")).alias("src"),
                _node(VALUE, F.lit(c), F.col("value_b")).alias("dst"),
            )
        else:
            sim = _token_set_edges(values, c, 1.0 - (threshold if threshold is not None else 0.3))
        edges = sim if edges is None else edges.unionByName(sim)
    return edges


def _token_set_edges(values: DataFrame, column: str, min_similarity: float) -> DataFrame:
    from twinsift.operators.minhash import jaccard_pairs, set_id, token_set

    v = values.select(F.col("v")).distinct().withColumn("tokens", token_set("v")).filter(F.size("tokens") > 0)
    v = v.withColumn("set_id", set_id("tokens"))
    member = v.select(
        _node(VALUE, F.lit(column), F.col("v")).alias("src"), _node(SET, F.lit(column), F.col("set_id")).alias("dst")
    )
    sets = v.select("set_id", "tokens", F.size("tokens").alias("n")).distinct()
    similar = jaccard_pairs(sets, min_similarity).select(
        _node(SET, F.lit(column), F.col("set_a")).alias("src"), _node(SET, F.lit(column), F.col("set_b")).alias("dst")
    )
    return member.unionByName(similar)


def value_groups(df: DataFrame, column: str, method: str = "fuzzy_levenshtein", threshold: float | None = None) -> DataFrame:
    """``column_name, value, representative, n_rows``: normalised values of one
    column that are similar to others, each with the smallest value of its
    group and the number of its rows."""
    comps = connected_components(similarity_edges(df, [column], method=method, threshold=threshold))
    values = df.select(normalized(column).alias("value")).filter("value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
    tagged = values.withColumn("node", _node(VALUE, F.lit(column), F.col("value"))).join(comps, "node")
    least = tagged.groupBy("component").agg(F.min("value").alias("representative"), F.count(F.lit(1)).alias("__n"))
    out = tagged.join(least.filter(F.col("__n") > 1), "component")
    return out.select(F.lit(column).alias("column_name"), "value", "representative", "n_rows")


def entity_clusters(
    df: DataFrame,
    columns: Sequence[str] = ("name", "email"),
    id_col: str = "id",
    method: str = "fuzzy_levenshtein",
    threshold: float | None = None,
) -> DataFrame:
    """``id, cluster_id`` per distinct id: rows are in one cluster when a
    chain of equal or similar key values links them (any of ``columns``);
    the cluster is named by its smallest id."""
    comps = connected_components(similarity_edges(df, columns, id_col, method, threshold))
    # a row is in the component of any of its values; one without values is alone
    first = F.coalesce(*[_value_node(c) for c in columns], _node(ROW, F.col(id_col).cast("string")))
    rows = df.select(F.col(id_col).cast("string").alias(id_col), first.alias("node")).distinct()
    # a value in no edge at all (one column, nothing similar) is its own component
    rows = rows.join(comps, "node", "left").select(id_col, F.coalesce("component", "node").alias("component"))
    named = rows.groupBy("component").agg(F.min(id_col).alias("cluster_id"))
    return rows.join(named, "component").select(id_col, "cluster_id").distinct()


def resolve_entities(
    df: DataFrame,
    method: str = "fuzzy_levenshtein",
    columns: Sequence[str] = ("name", "email"),
    id_col: str = "id",
    threshold: float | None = None,
) -> DataFrame:
    """One row per cluster of similar records: the row with the smallest id."""
    clusters = entity_clusters(df, columns, id_col, method, threshold).withColumnRenamed(id_col, "__cid")
    tagged = df.join(clusters, F.col(id_col).cast("string") == F.col("__cid"), "left").drop("__cid")
    return keep_one(tagged, ["cluster_id"], order_by=[id_col]).drop("cluster_id")
