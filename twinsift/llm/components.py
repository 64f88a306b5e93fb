"""Connected components of a link table, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of one orderable type -> ``(node, root)``: for each node
    with a link to another the smallest node that links lead to.

    Alternates the large-star and small-star steps (each a map-side combined
    minimum and a join on the centre) until a round changes nothing; the
    number of rounds follows the logarithm of the longest path. Each round is
    written to the shared folder. Null ends and self links are left out."""
    edges = stage(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        # large star: every larger neighbour of u goes to the smallest of u's neighbourhood
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(large.where("u <> v").distinct(), "links")
        # small star: u and its smaller neighbours go to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
