"""Connected components that grow batch by batch.

The labels (node, component) are a stored table. A batch of edges is contracted
by them first: both ends become the names of their components (a node that is
not there yet is its own), so the components of the batch are found in a graph
of the batch's size. Written are the nodes that are new and the nodes of
components that the batch joined to others, and no other row.

The table is append-only, a folder a batch; a node's label is that of its latest
batch. A batch that comes again replaces its own folder, so a failure between
two batches leaves no trace. A component is named by its smallest node, as
``clusters.connected_components`` names it: joining a large component to a
smaller name writes all its nodes again. ``compact`` folds the folders into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.operators.clusters import connected_components
from twinsift.session import cut_lineage, path_exists


class LabelStore:
    """The labels below ``path``; nodes are strings."""

    SCHEMA = "node string, component string, batch long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def current(self, before: int | None = None) -> DataFrame:
        """``node, component`` as of now, or as of the batches ``before`` one."""
        rows = self._rows()
        if before is not None:
            rows = rows.filter(F.col("batch") < before)
        return rows.groupBy("node").agg(F.max_by("component", "batch").alias("component"))

    def add(self, edges: DataFrame, batch: int, src: str = "src", dst: str = "dst") -> int:
        """Take in a batch of edges (an edge with one end, or from a node to
        itself, names a node). Returns how many rows were written."""
        labels = self.current(batch)
        given = cut_lineage(edges.select(F.coalesce(src, dst).alias("u"), F.coalesce(dst, src).alias("v")).where("u is not null").distinct())
        ends = given.select(F.col("u").alias("node")).unionByName(given.select(F.col("v").alias("node"))).distinct()
        # the batch's nodes with their components; the labels are cut to them where they are read
        known = cut_lineage(ends.join(labels, "node", "left").select("node", F.col("component").alias("had"), F.coalesce("component", "node").alias("at")))
        side = lambda c: known.select(F.col("node").alias(c), F.col("at").alias(f"{c}_at"))
        contracted = given.join(side("u"), "u").join(side("v"), "v").select(F.col("u_at").alias("src"), F.col("v_at").alias("dst")).distinct()
        found = cut_lineage(connected_components(contracted).select(F.col("node").alias("at"), F.col("component").alias("to")))
        added = known.where("had is null").join(found, "at").select("node", F.col("to").alias("component"))
        moved = found.where("at <> to")
        changed = labels.join(moved, labels.component == moved["at"]).select("node", F.col("to").alias("component"))
        target = f"{self.path}/batch={batch}"
        added.unionByName(changed).write.mode("overwrite").parquet(target)
        return self.spark.read.parquet(target).count()

    def compact(self, target: str) -> LabelStore:
        """The labels in one folder of a new store at ``target``, which goes on
        with the batch numbers of this one."""
        last = self._rows().agg(F.max("batch")).first()[0] or 0
        self.current().write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={last}")
        return LabelStore(self.spark, target)
