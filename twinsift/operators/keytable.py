"""The keys that exist already, kept as a bucketed table, so that a batch is
compared with them without moving them.

The table holds each key once, dealt by the keys' hash into ``buckets`` files
and sorted in them. A batch's distinct keys are dealt out the same way and meet
their bucket where it lies: the plan has no exchange on the table's side,
whatever its size, and the batch's is as small as the batch. A key that holds a
third of a batch is one row by the time it is dealt out.

A key with a NULL in it matches nothing: such rows are always new, and the
table doesn't hold them. Each ``add`` writes one more file to every bucket it has
keys for; ``compact`` makes them one again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.functions.keys import fresh
from twinsift.operators.exact import drop_null_keys
from twinsift.session import scratch_path
from twinsift.sources.sinks import write_bucketed


class KeyTable:
    """A handle on the table called ``table`` (of the session's catalog)."""

    def __init__(self, spark: SparkSession, table: str, keys: Sequence[str], buckets: int):
        self.spark, self.table, self.keys, self.buckets = spark, table, list(keys), buckets

    @classmethod
    def create(cls, existing: DataFrame, keys: Sequence[str], buckets: int, table: str | None = None, path: str | None = None) -> KeyTable:
        """The keys of ``existing`` as a table, at ``path`` (else in a fresh
        folder of the shared checkpoint folder). Take as many buckets as give
        some hundred megabytes of keys each."""
        spark = existing.sparkSession
        table = table or f"keys_{uuid.uuid4().hex}"
        got = cls(spark, table, keys, buckets)
        got._write(got._own(existing), "overwrite", path or scratch_path(spark, "keys"))
        return got

    def _own(self, df: DataFrame) -> DataFrame:
        return drop_null_keys(df.select(*self.keys), self.keys).distinct()

    def _write(self, keys: DataFrame, mode: str, path: str | None = None, table: str | None = None) -> None:
        # dealt out as the buckets are: a task writes one file
        dealt = keys.repartition(self.buckets, *self.keys)
        write_bucketed(dealt, table or self.table, self.keys, self.buckets, sort_by=self.keys, mode=mode, path=path)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def _seen(self, new: DataFrame) -> DataFrame:
        """The batch's keys that the table holds."""
        return self._own(new).join(self.read(), self.keys, "left_semi")

    def unseen(self, new: DataFrame) -> DataFrame:
        """The rows of ``new`` whose key the table doesn't hold."""
        names = [fresh(f"__seen{i}", new) for i in range(len(self.keys))]
        same = [new[k] == F.col(n) for k, n in zip(self.keys, names, strict=True)]
        return new.join(self._seen(new).toDF(*names), same, "left_anti")

    def add(self, new: DataFrame) -> None:
        """Put the keys of ``new`` that aren't there into the table. Adding a
        batch again adds nothing, so a batch can be repeated after a failure."""
        names = [f"__k{i}" for i in range(len(self.keys))]
        held = self.read().toDF(*names)
        own = self._own(new)
        missing = own.join(held, [own[k] == F.col(n) for k, n in zip(self.keys, names, strict=True)], "left_anti")
        # written apart first: a job can't append to the table it reads
        stage = scratch_path(self.spark, "keys-new")
        missing.write.parquet(stage)
        self._write(self.spark.read.schema(missing.schema).parquet(stage), "append")
        self.spark.catalog.refreshTable(self.table)

    def compact(self, path: str | None = None) -> None:
        """One sorted file a bucket again. The new table is complete before it
        takes the old one's name; the old files stay where they are."""
        other = f"{self.table}_{uuid.uuid4().hex[:8]}"
        self._write(self.read(), "overwrite", path or scratch_path(self.spark, "keys"), other)
        old = f"{other}_old"
        self.spark.sql(f"ALTER TABLE {self.table} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {other} RENAME TO {self.table}")
        self.spark.sql(f"DROP TABLE {old}")
