"""A Merkle tree over a table, checked leaf by leaf by a recursive query.

A row's leaf is the hash of its columns (each ``-`` if null, else its UTF-8
byte count, ``:`` and its value). In each tree (here: of one source) the
leaves stand in the order of the ids; every ``FAN`` = 3 consecutive nodes
become their hash, level by level, until one node remains, the tree's root;
those of all trees, in the order of the tree names, are the leaves of the
tree on top.

Building: leaves are numbered by a range sort and the counts of its ranges, so
no tree has to be in one task. ``LEVELS`` levels are built in one grouping of
3**LEVELS consecutive nodes; what is stored are node rows with a link to the
node LEVELS above (or the last one of its tree, which is linked to its leaf of
the tree on top) and the siblings met on the way, left and right of each
level. A tree with a third of all rows only has more such groups.

Climbing: a recursive query starts with one row a leaf, at its first link. Each
step joins the stored rows of the node reached, folds the hash that the leaf
is claimed to have through that link's siblings, and appends these to what
the leaf has passed. The links near the top serve very many leaves: they are
stored several times, under salts, so that a step is dealt evenly. The number
of steps is log(rows) / LEVELS.

Null columns are part of the leaf as ``-``; null ids stand first, and the null
tree name before all others. Rows with equal ids in one tree stand in the
order of their leaves; repeated rows are leaves of their own (which of them
stands first makes no difference, they are equal). Empty and long texts
are hashed like others. An empty table gives an empty result and has no root.
The result has fixed columns beside those named in ``keep``, of which those
with a new column's name are left out; other columns don't matter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from twinsift.llm.common import stage

FAN = 3
LEVELS = 4
WIDTH = FAN**LEVELS
#: The tree on top of the others.
TOP = -1


def token(c: Column) -> Column:
    """A value as it is hashed."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    """The leaf of a row, as hex text."""
    return F.sha2(F.concat(*[token(c) for c in columns]), 256)


def _salts(df: DataFrame) -> int:
    return 4 * max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _numbered(rows: DataFrame, by: list[str], tree: str | None, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in the order ``by``, with ``pos`` (from 0 in each ``tree``,
    the first of ``by``), and the ranges' counts. Rows are dealt by ranges of
    the order and numbered in their range; what stands before a range comes
    from the counts."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stage(rows.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in by]).withColumn("part", F.spark_partition_id()), name)
    trees = [tree] if tree else []
    counts = stage(dealt.groupBy("part", *trees).agg(F.count("*").alias("n")), f"{name}-counts")
    one = F.lit(0)
    before = Window.partitionBy(*(trees or [one])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    if tree:
        offsets = offsets.withColumnRenamed(tree, "tree_")
        same = (F.col("part_") == F.col("part")) & F.col("tree_").eqNullSafe(F.col(tree))
    else:
        same = F.col("part_") == F.col("part")
    place = F.row_number().over(Window.partitionBy("part", *trees).orderBy(*[F.col(c).asc_nulls_first() for c in by])) - 1
    got = dealt.withColumn("place", place).join(offsets.withColumnRenamed("part", "part_"), same)
    got = got.withColumn("pos", (F.col("place") + F.col("before")).cast("long"))
    return got.drop("place", "before", "part", "part_", "tree_"), counts


def _group(nodes: DataFrame) -> DataFrame:
    """``nodes(tree, pos, m, hash, ..)`` of trees with m nodes -> one row a
    group of WIDTH of them: ``tree, parent, m, made`` (the group's node above,
    or the tree's root), ``levels`` (arrays of hex hashes) and ``rows``."""
    payload = [c for c in nodes.columns if c not in ("tree", "pos", "m")]
    g = nodes.groupBy("tree", F.expr(f"pos div {WIDTH}").alias("parent"), "m").agg(F.array_sort(F.collect_list(F.struct("pos", *payload))).alias("rows"))
    levels = F.array(F.expr("transform(rows, r -> lower(hex(r.hash)))"))
    got = g.withColumn("l0", levels[0]).withColumn("high", F.lit(0))
    for k in range(1, LEVELS + 1):
        # a level is there as long as the whole tree has more than one node below it
        goes = F.col("m") > FAN ** (k - 1)
        up = F.expr(f"transform(sequence(0, (size(l{k - 1}) - 1) div {FAN}), i -> sha2(array_join(slice(l{k - 1}, {FAN} * i + 1, {FAN}), ''), 256))")
        got = got.withColumn(f"l{k}", F.when(goes, up).otherwise(F.col(f"l{k - 1}"))).withColumn("high", F.col("high") + goes.cast("int"))
    return got.withColumn("made", F.unhex(F.col(f"l{LEVELS}")[0]))


def _siblings() -> Column:
    """(left, right) hashes of node ``i`` of a group at each of its levels."""
    sides = []
    for k in range(LEVELS):
        at = f"(i div {FAN**k})"
        run = f"{FAN} * ({at} div {FAN})"
        left = f"unhex(array_join(slice(l{k}, {run} + 1, {at} - {run}), ''))"
        right = f"unhex(array_join(slice(l{k}, {at} + 2, {FAN} - 1 - ({at} - {run})), ''))"
        sides.append(f"if({k} < high, named_struct('l', {left}, 'r', {right}), null)")
    return F.expr(f"array_compact(array({', '.join(sides)}))")


def _links(groups: DataFrame, stride: int, top: bool) -> DataFrame:
    """One row a node: where it is, where its link leads, what is met on the way."""
    each = groups.select("*", F.posexplode("rows").alias("i", "row"))
    ends = F.col("m") <= WIDTH
    own = F.col("tree") == TOP if top else F.lit(False)
    return each.select(
        "tree",
        F.lit(stride).alias("stride"),
        F.col("row.pos").alias("pos"),
        F.when(ends & own, F.lit(None)).when(ends, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("to_tree"),
        F.when(ends, 0).otherwise(stride + 1).alias("to_stride"),
        F.when(ends, F.col("tree")).otherwise(F.col("parent")).cast("long").alias("to_pos"),
        _siblings().alias("met"),
        F.when(ends, F.col("made")).alias("made"),
        *[F.col(f"row.{f.name}").alias(f.name) for f in groups.schema["rows"].dataType.elementType.fields if f.name != "pos"],
    )


def _trees(nodes: DataFrame, widest: int, salts: int, top: bool) -> tuple[list[DataFrame], DataFrame | None]:
    """All links of the trees in ``nodes(tree, pos, m, hash, ..)``, stride by
    stride, and the roots ``(tree, hash)``. The links beyond the first stride
    (and all of the tree on top) are salted."""
    out, roots, stride = [], None, 0
    while True:
        groups = stage(_group(nodes), "merkle-groups")
        links = _links(groups, stride, top)
        spread = salts if top else min(WIDTH ** max(0, stride - 1), salts)
        if top or stride:
            links = links.drop("hash").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        out.append(links)
        ended = groups.where(F.col("m") <= WIDTH).select("tree", F.col("made").alias("hash"))
        roots = ended if roots is None else roots.unionByName(ended)
        if widest <= WIDTH:
            return out, roots
        nodes = groups.where(F.col("m") > WIDTH).select("tree", F.col("parent").alias("pos"), F.expr(f"(m + {WIDTH - 1}) div {WIDTH}").alias("m"), F.col("made").alias("hash"))
        widest, stride = -(-widest // WIDTH), stride + 1


def _spread(stride: Column, tree: Column, salts: int) -> Column:
    """How many salts the links of a stride are stored under."""
    grown = F.lit(1)
    k = 2
    while WIDTH ** (k - 1) < salts:
        grown = F.when(stride >= k, WIDTH ** (k - 1)).otherwise(grown)
        k += 1
    return F.when(tree == TOP, salts).when(stride >= k, salts).otherwise(grown)


def _fold(claimed: str, met: str) -> str:
    """The hash that ``claimed`` becomes between the siblings met."""
    return f"aggregate({met}, {claimed}, (h, s) -> unhex(sha2(lower(hex(concat(s.l, h, s.r))), 256)))"


def manifest(rows: DataFrame, tree: str, id_col: str, leaf: str = "leaf", claimed: str = "claimed", keep: list[str] | None = None) -> DataFrame:
    """``rows(tree, id, leaf, claimed)`` (hashes as hex text) -> for each row
    ``leaf, subroot, root`` (hex text), ``proof`` (the siblings on its way to
    the root as hex text, level by level and left to right), ``folded_root``
    (from ``claimed`` and the siblings) and ``verified``."""
    salts = _salts(rows)
    new = ("leaf", "subroot", "root", "proof", "folded_root", "verified")
    keep = [c for c in ([id_col] if keep is None else keep) if c.lower() not in new]
    leaves = rows.select(F.col(tree).cast("string").alias("name"), F.col(id_col).alias("id"), F.unhex(F.col(leaf)).alias("hash"), F.unhex(F.col(claimed)).alias("claim"), F.struct(*keep).alias("kept"))
    # written before they are ranged, which reads them twice: a text is hashed once
    numbered, counts = _numbered(stage(leaves, "merkle-hashed"), ["name", "id", "hash"], "name", "merkle-leaves")
    sizes = stage(counts.groupBy("name").agg(F.sum("n").alias("m")), "merkle-sizes")
    ranked, _ = _numbered(sizes, ["name"], None, "merkle-names")
    ranked = stage(ranked.withColumnRenamed("pos", "tree"), "merkle-trees")
    widest, trees = ranked.agg(F.coalesce(F.max("m"), F.lit(0)), F.count("*")).first()
    named = ranked.withColumnRenamed("name", "name_")
    nodes = numbered.join(named, F.col("name").eqNullSafe(F.col("name_"))).select("tree", "pos", "m", "hash", "claim", "kept")

    below, roots = _trees(nodes, widest, salts, False)
    roots = stage(roots, "merkle-roots")
    above, _ = _trees(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees).alias("m"), "hash"), trees, salts, True)

    start = stage(below[0], "merkle-start")
    columns = ["tree", "stride", "pos", "salt", "to_tree", "to_stride", "to_pos", "met", "made"]
    links = [x.select(*columns) for x in [*below[1:], *above]]
    stored = links[0]
    for x in links[1:]:
        stored = stored.unionByName(x)
    stored = stage(stored, "merkle-links")
    passed = climb(start, stored, salts)

    # what a leaf has passed, in order; a handful of rows each
    by_leaf = passed.groupBy("tree", "pos").agg(F.array_sort(F.collect_list(F.struct("step", "met", "made", "folded"))).alias("way"), F.first("kept", ignorenulls=True).alias("kept"), F.first("leaf", ignorenulls=True).alias("leaf"))
    hexed = lambda c: F.lower(F.hex(c))
    ends = F.expr("filter(way, w -> w.made is not null)")
    got = by_leaf.select(
        "kept.*",
        hexed(F.col("leaf")).alias("leaf"),
        hexed(ends[0]["made"]).alias("subroot"),
        hexed(F.element_at("way", -1)["made"]).alias("root"),
        F.expr("array_join(flatten(transform(way, w -> transform(w.met, s -> lower(hex(concat(s.l, s.r)))))), '')").alias("proof"),
        hexed(F.element_at("way", -1)["folded"]).alias("folded_root"),
    )
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def climb(start: DataFrame, links: DataFrame, salts: int) -> DataFrame:
    """The recursive query: one row a leaf and step, ``tree, pos`` (the leaf),
    ``step``, ``met``, ``made`` (the root reached, if any), ``folded``, and in
    the first step ``kept`` and ``leaf``."""
    spark = start.sparkSession
    tag = uuid.uuid4().hex[:12]
    views = {"start": f"merkle_start_{tag}", "links": f"merkle_links_{tag}"}
    salt = lambda who, step: F.pmod(F.xxhash64(*[F.col(c) for c in who], F.lit(step) if isinstance(step, int) else step), _spread(F.col("to_stride"), F.col("to_tree"), salts))
    first = start.withColumn("next_salt", salt(["tree", "pos"], 0))
    first.createOrReplaceTempView(views["start"])
    links.withColumn("spread", _spread(F.col("to_stride"), F.col("to_tree"), salts)).createOrReplaceTempView(views["links"])
    try:
        return spark.sql(f"""
            WITH RECURSIVE way (tree, pos, step, met, made, folded, kept, leaf, to_tree, to_stride, to_pos, salt) AS (
                SELECT tree, pos, 0, met, made, {_fold("claim", "met")}, kept, hash, to_tree, to_stride, to_pos, next_salt
                FROM {views["start"]}
              UNION ALL
                SELECT w.tree, w.pos, w.step + 1, l.met, l.made, {_fold("w.folded", "l.met")},
                       CAST(NULL AS {first.schema["kept"].dataType.simpleString()}), CAST(NULL AS BINARY),
                       l.to_tree, l.to_stride, l.to_pos, pmod(xxhash64(w.tree, w.pos, w.step + 1), l.spread)
                FROM way w JOIN {views["links"]} l
                  ON w.to_tree = l.tree AND w.to_stride = l.stride AND w.to_pos = l.pos AND w.salt = l.salt
            )
            SELECT tree, pos, step, met, made, folded, kept, leaf FROM way LIMIT ALL""")
    finally:
        for v in views.values():
            spark.catalog.dropTempView(v)
