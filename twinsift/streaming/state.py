"""Deduplication by keyed state: what was seen is in the state store, for a
limited time if asked.

``first_seen`` lets the first row of each key pass and drops the others, over
all batches and restarts. A key's state is one flag in the RocksDB state store,
so a batch touches the keys it has and no others, however many are held. With
``ttl_seconds`` a key is forgotten that long (processing time) after it was
let through; a row that comes later passes again. There is no event time and no
watermark: late rows are judged like others.

A batch is cut to one row a key of each Arrow batch before it is shuffled, so
a key with a third of all rows sends a row for some thousands it has. Within
the state's task a key's rows are read one after the other, never gathered.
NULL is a key value like any other.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

# pickled by value: executors need pyarrow and pandas, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _orderable(t: DataType) -> bool:
    return not isinstance(t, ArrayType | MapType | StructType | VariantType)


def _place(value) -> tuple:
    """NULL first, NaN last."""
    if value is None:
        return (0, 0)
    return (2, 0) if isinstance(value, float) and math.isnan(value) else (1, value)


class FirstSeen(StatefulProcessor):
    """Lets a key's first row (in ``order``) pass once."""

    def __init__(self, order: Sequence[str], ttl_seconds: int | None):
        self.order = list(order)
        self.ttl = None if ttl_seconds is None else int(ttl_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = min(rows, key=lambda r: tuple(_place(r[c]) for c in self.order))
        if not self.seen.exists():
            self.seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def _one_a_key(keys: Sequence[str], order: Sequence[str]):
    """A ``mapInArrow`` function: of each batch, the first row of every key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if order:
                t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
            named = t.select(keys).rename_columns([f"k{i}" for i in range(len(keys))])
            found = named.append_column("at", pa.array(np.arange(t.num_rows))).group_by(named.column_names).aggregate([("at", "min")])
            yield from t.take(found.column("at_min")).to_batches()

    return run


def first_seen(stream: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), ttl_seconds: int | None = None) -> DataFrame:
    """One row for each key of the stream: of the batch that has it first, the
    first row by ``order_by``, then by the other columns. The keys are told
    apart by their values; columns without an order (arrays, maps, structs)
    break no ties. Run it inside ``keyed_state``."""
    keys = list(keys)
    order = [*order_by, *[f.name for f in stream.schema.fields if f.name not in {*keys, *order_by} and _orderable(f.dataType)]]
    reduced = stream.mapInArrow(_one_a_key(keys, order), stream.schema)
    return reduced.groupBy(*keys).transformWithState(
        FirstSeen(order, ttl_seconds), outputStructType=stream.schema, outputMode="append", timeMode="none" if ttl_seconds is None else "processingTime"
    )


@contextmanager
def session_settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for the queries started inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def in_stores(spark: SparkSession, stores: int):
    """Queries that first start inside keep their state in so many stores
    (``plans.sizing.state_stores``); their checkpoints hold on to the number."""
    return session_settings(spark, {"spark.sql.shuffle.partitions": str(stores)})


def keyed_state(spark: SparkSession):
    """The session settings that keyed state needs, for the queries started
    inside: the RocksDB store, and no batches without data (a state with a time
    to live would ask for one after the other, so that a query over what is
    available would never end). They are put back afterwards."""
    return session_settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"})
