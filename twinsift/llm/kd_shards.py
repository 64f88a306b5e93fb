"""Sharding by a k-d tree over document metadata. DataFrame operations only.

Equal texts form a group: one point with coordinates from the group's
metadata and the bytes of all its rows as weight, so copies stay together.
A node is split at the weighted median of its widest dimension (its extent
over the extent of all points); equal coordinates are told apart by the
text's hash. Nodes with more than one shard's bytes are split again, in
proportion to the shards they stand for, until leaves reach the target.

The medians are found without sorting and without gathering a node's points:
weights are added up in 1,024 bins of each node's range and the bin that
holds the median is refined. A job serves all nodes of a level; the driver sees only bin
sums and the tree, whose size is that of the list of shards. A group that is
heavier than an even split leaves room for goes whole to one side, and the
cut moves so that the other points make up for it.

Null texts have no bytes (size 1) and are a group of their own beside the
empty ones (both have the same hash and stay together). Null metadata counts
as the smallest value, null ids as well. Repeated rows are sized and placed
each. An empty table has no shards. Long texts cost one hash. All columns of
the input stay, except that new names replace old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from twinsift.llm.common import own_names, stage, values

BINS = 1024
#: Points of the bins in question that the driver may sort instead of asking again, over all nodes.
FEW = 1 << 12


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus one."""
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 1).cast("long")


def _code(c: Column) -> Column:
    """Text metadata as an ordered number: its first seven bytes."""
    return F.conv(F.rpad(F.substring(F.hex(F.coalesce(c.cast("string"), F.lit(""))), 1, 14), 14, "0"), 16, 10).cast("long")


def _split_points(points: DataFrame, nodes: dict[int, dict]) -> None:
    """Give every node of ``nodes`` its cut: ``value`` and ``tie`` such that
    the points with (coordinate, hash) <= (value, tie) hold its share. ``last``
    is the point (value, tie, weight) that the share ended in, ``error`` by how
    much the cut misses it."""
    spark = points.sparkSession
    open_ = {k: {"tied": False, "at": 0, "lo": n["lo"], "hi": n["hi"], "base": 0} for k, n in nodes.items()}
    while open_:
        for s in open_.values():
            s["step"] = max(1, -(-(s["hi"] - s["lo"] + 1) // BINS))
        asked = values(spark, [(k, s["tied"], s["at"], s["lo"], s["hi"], s["step"]) for k, s in open_.items()], "node long, tied boolean, at long, lo long, hi long, step long")
        key = F.when(F.col("tied"), F.col("tie")).otherwise(F.col("x"))
        inside = key.between(F.col("lo"), F.col("hi")) & (~F.col("tied") | (F.col("x") == F.col("at")))
        met = points.select("node", "x", "tie", "w").join(F.broadcast(asked), "node").where(inside)  # one row a node of the tree
        bins: dict[int, dict[int, tuple[int, int]]] = {}
        for r in met.groupBy("node", F.expr("(case when tied then tie else x end - lo) div step").alias("bin")).agg(F.sum("w"), F.count("*")).collect():  # nodes x bins at most
            bins.setdefault(r[0], {})[r[1]] = (r[2], r[3])
        few: dict[int, tuple[int, int]] = {}
        for k, s in list(open_.items()):
            if k not in bins:  # nothing to split
                nodes[k] |= {"value": s["lo"] - 1, "tie": 0, "error": 0, "last": (s["lo"] - 1, 0, 0)}
                del open_[k]
                continue
            goal, run = nodes[k]["goal"], s["base"]
            hit = max(bins[k])
            for b in sorted(bins[k]):
                if run + bins[k][b][0] >= goal or b == hit:
                    hit = b
                    break
                run += bins[k][b][0]
            s["base"], s["lo"] = run, s["lo"] + hit * s["step"]
            s["hi"] = s["lo"] + s["step"] - 1
            if bins[k][hit][1] <= max(16, FEW // len(nodes)):
                few[k] = (s["lo"], s["hi"])
            elif s["step"] == 1 and not s["tied"]:
                s |= {"tied": True, "at": s["lo"], "lo": 0, "hi": (1 << 60) - 1}
        if not few:
            continue
        wanted = values(spark, [(k, open_[k]["tied"], open_[k]["at"], a, b) for k, (a, b) in few.items()], "node long, tied boolean, at long, lo long, hi long")
        rows: dict[int, list] = {}
        for r in points.select("node", "x", "tie", "w").join(F.broadcast(wanted), "node").where(inside).select("node", "x", "tie", "w").collect():
            rows.setdefault(r[0], []).append(tuple(r[1:]))
        for k in few:
            goal, run = nodes[k]["goal"], open_[k]["base"]
            at = sorted(rows[k])
            for x, tie, w in at:
                if run + w >= goal or (x, tie, w) == at[-1]:
                    over, under = run + w - goal, goal - run
                    nodes[k] |= {"value": x, "tie": tie if over <= under else tie - 1, "error": min(abs(over), abs(under)), "last": (x, tie, w)}
                    break
                run += w
            del open_[k]


def assign(points: DataFrame, shards: int | None, target_bytes: int | None, dims: list[str]) -> tuple[DataFrame, int]:
    """``points(tie, w, <dims>)`` -> points with ``shard``, and how many."""
    points = stage(points.withColumn("node", F.lit(0).cast("long")).withColumn("shard", F.lit(None).cast("int")), "points")
    if not shards:
        shards = max(1, -(-(points.agg(F.sum("w")).first()[0] or 0) // max(1, target_bytes or 1)))
    extent = None
    todo = {0: (0, shards)}  # node -> (first shard, shards)
    while todo:
        done = {k: v for k, v in todo.items() if v[1] == 1}
        todo = {k: v for k, v in todo.items() if v[1] > 1}
        rows = [(k, v[0], v[1]) for k, v in {**done, **todo}.items()]
        plan = values(points.sparkSession, [(k, a) for k, a, n in rows if n == 1], "node long, leaf int")
        points = points.join(F.broadcast(plan), "node", "left").withColumn("shard", F.coalesce("shard", "leaf")).drop("leaf")
        if not todo:
            break
        live = points.where("shard is null")
        stats = {r["node"]: r for r in live.groupBy("node").agg(F.sum("w").alias("w"), *[f(c).alias(f"{n}_{c}") for c in dims for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        if extent is None and stats:
            extent = {c: max(1, stats[0][f"hi_{c}"] - stats[0][f"lo_{c}"]) for c in dims}
        nodes, following = {}, {}
        for k, (a, n) in todo.items():
            if k not in stats:
                continue
            r, half = stats[k], n // 2
            wide = max(dims, key=lambda c: ((r[f"hi_{c}"] - r[f"lo_{c}"]) / extent[c], c))
            nodes[k] = {"dim": wide, "lo": r[f"lo_{wide}"], "hi": r[f"hi_{wide}"], "goal": r["w"] * half / n}
            following |= {2 * k + 1: (a, half), 2 * k + 2: (a + half, n - half)}
        if not nodes:
            break
        chosen = values(points.sparkSession, [(k, n["dim"]) for k, n in nodes.items()], "node long, dim string")
        x = F.coalesce(*[F.when(F.col("dim") == c, F.col(c)) for c in dims])
        flat = live.join(F.broadcast(chosen), "node").select("node", x.alias("x"), "tie", "w")
        _split_points(flat, nodes)
        # a heavy point that a cut ran into goes left as a whole, and the cut is made anew without it
        heavy = {k: n["last"] for k, n in nodes.items() if n["error"] > 0.002 * n["goal"]}
        if heavy:
            apart = values(points.sparkSession, [(k, v, t) for k, (v, t, _) in heavy.items()], "node long, hx long, htie long")
            others = flat.join(F.broadcast(apart), "node").where(~((F.col("x") == F.col("hx")) & (F.col("tie") == F.col("htie")))).select("node", "x", "tie", "w")
            again = {k: nodes[k] | {"goal": nodes[k]["goal"] - heavy[k][2]} for k in heavy}
            _split_points(others, again)
            nodes |= again
        cuts = values(points.sparkSession, [(k, n["dim"], n["value"], n["tie"], *heavy.get(k, (None, None))[:2]) for k, n in nodes.items()], "node long, dim string, at long, cut long, hx long, htie long")
        left = (x < F.col("at")) | ((x == F.col("at")) & (F.col("tie") <= F.col("cut"))) | F.coalesce((x == F.col("hx")) & (F.col("tie") == F.col("htie")), F.lit(False))
        moved = points.join(F.broadcast(cuts), "node", "left").withColumn("node", F.when(F.col("dim").isNull() | F.col("shard").isNotNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 1).otherwise(2)))
        points = stage(moved.drop("dim", "at", "cut", "hx", "htie"), "kd")
        todo = following
    return points, shards


@own_names
def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text", id_col: str = "doc_id", metadata: tuple[str, ...] = ("source", "lang", "n_chars")) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``,
    ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (null)."""
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "text_hash")
    keep = [c for c in docs.columns if c.lower() not in new]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sized = docs.withColumn("__size", size_of(text)).withColumn("__crc", F.crc32(t.cast("binary"))).withColumn("__sha", F.sha2(t, 256))
    own = [c for c in metadata if c in docs.columns]
    number = {"tinyint", "smallint", "int", "bigint"}
    dims = {f"__d{i}": F.coalesce(F.col(c).cast("long"), F.lit(-1)) if docs.schema[c].dataType.simpleString() in number else _code(F.col(c)) for i, c in enumerate(own)}
    dims |= {"__d_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-1)) if docs.schema[id_col].dataType.simpleString() in number else _code(F.col(id_col)), "__d_size": F.col("__size")}
    rest = [c for c in keep if c != text]
    rows = stage(sized.select(*rest, "__size", "__crc", "__sha", *[c.alias(n) for n, c in dims.items()]), "sized")
    groups = rows.groupBy("__sha").agg(F.sum("__size").alias("w"), *[F.min(n).alias(n) for n in dims])
    # 62 bits of the hash are the tie; the whole hash stays the key
    points = groups.withColumn("tie", F.conv(F.substring("__sha", 1, 15), 16, 10).cast("long"))
    placed, _ = assign(points, shards, target_bytes, list(dims))
    got = rows.join(placed.select("__sha", F.coalesce("shard", F.lit(0)).alias("__shard")), "__sha")
    # slots: places before a row's bucket, and its place in the bucket
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    got = stage(got.withColumn("__b", F.pmod(F.xxhash64(F.lit("slot"), F.col(id_col), "__sha"), F.lit(n * 8))), "sharded")
    w = Window.partitionBy("__shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = got.groupBy("__shard", "__b").agg(F.count("*").alias("c")).withColumn("__before", F.coalesce(F.sum("c").over(w), F.lit(0))).drop("c")
    inner = F.row_number().over(Window.partitionBy("__shard", "__b").orderBy(id_col, "__sha")) - 1
    got = got.withColumn("__in", inner).join(before, ["__shard", "__b"])
    return got.select(
        *rest,
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("__shard").cast("int").alias("shard"),
        (F.col("__in") + F.col("__before")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("__sha").alias("text_hash"),
    )
