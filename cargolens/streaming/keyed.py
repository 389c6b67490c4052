"""Latest row per key, held by the stream itself.

The state store keeps one row per key. A row replaces it only if it comes later in the table's order, whatever batch brings
it and however often the stream restarts, and only rows that replaced one leave the stream. Readers take the
state as it stands after the last batch; there are no slices to merge.

Without a time to live the state is that of Spark's own streaming aggregation. Each task sends the latest row of a key, so a hot
key costs its task one row, and no row passes through Python.

With a time to live, a key that no newer row has touched for that long is forgotten. Only a processor of one's own can do that: it asks
Spark's state server twice per key and batch, and suits few keys. There, each task sends the latest row of a key per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE, BATCH, REST = "latest", "_batch", "_rest"
#: How the state is kept: in blocks that compress well, as a batch asks for its keys in order, and for the last two batches.
KEPT = {
    PROVIDER: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state needs; others are left as they are."""
    before = {key: spark.conf.get(key, None) for key in KEPT}
    for key, value in KEPT.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def rank(values: Sequence[Any]) -> tuple:
    """Comparable form of an order tuple; null comes before everything, as in Spark."""
    return tuple((v is not None, v) for v in values)


class Latest(StatefulProcessor):
    def __init__(self, schema: StructType, order: Sequence[str], ttl: timedelta | None):
        self.schema, self.names = schema, schema.fieldNames()
        self.order, self.ttl = list(order), ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = int(self.ttl.total_seconds() * 1000) if self.ttl else None
        self.row = handle.getValueState(STATE, self.schema, ttl)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        best = max(rows, key=lambda r: rank([r[c] for c in self.order]))
        held = self.row.get()
        places = [self.names.index(c) for c in self.order]
        if held is None or rank([held[p] for p in places]) < rank([best[c] for c in self.order]):
            values = tuple(best[c] for c in self.names)
            self.row.update(values)
            yield Row(**dict(zip(self.names, values, strict=True)))

    def close(self) -> None:
        pass


def thinned(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key per Arrow batch."""
    keys, order = list(keys), list(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                by = [(c, "ascending") for c in [*keys, *order]]
                rows = batch.take(pc.sort_indices(batch, sort_keys=by, null_placement="at_start"))
                last = pa.array([False] * (len(rows) - 1) + [True])
                for c in keys:
                    codes = rows.column(batch.schema.get_field_index(c)).dictionary_encode(null_encoding="encode").indices
                    changes = pc.not_equal(codes.slice(1), codes.slice(0, len(codes) - 1))
                    last = pc.or_(last, pa.concat_arrays([changes, pa.array([True])]))
                yield rows.filter(last)

    return stream.mapInArrow(run, stream.schema)


def latest(stream: DataFrame, keys: Sequence[str], order: Sequence[str], ttl: timedelta | None = None) -> DataFrame:
    """Update stream of the rows that became the latest of their key. Start it inside ``rocksdb``, in update mode."""
    if ttl:
        grouped = thinned(stream, keys, order).groupBy(*keys)
        return grouped.transformWithState(Latest(stream.schema, order, ttl), stream.schema, "Update", "ProcessingTime")
    # The time of the micro-batch, the same when it is run again. Of rows that are equal in the order the one held stays, as an
    # earlier batch ranks higher; and a row of this very batch is one that just came to be the latest.
    # The place of a row and the row are one value, so nothing is held twice; keys are those of the group.
    earlier = -F.unix_micros(F.current_timestamp())
    rest = [c for c in stream.columns if c not in {*keys, *order}]
    place = F.struct(*[F.col(c).alias(c) for c in order], F.col(BATCH), F.struct(F.lit(0).alias(BATCH), *rest).alias(REST))
    held = stream.withColumn(BATCH, earlier).groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.max(place).alias(STATE))
    key_of = lambda c: F.col(f"_key_{c}")
    return held.where(F.col(f"{STATE}.{BATCH}") == earlier).select(*_columns(stream.columns, keys, order, key_of, STATE))


def _columns(names: Sequence[str], keys: Sequence[str], order: Sequence[str], key_of: Callable[[str], Column], held: str) -> list[Column]:
    """The row's columns, from the key and the value of the state."""
    place = lambda c: f"{held}.`{c}`" if c in order else f"{held}.{REST}.`{c}`"
    return [(key_of(c) if c in keys and c not in order else F.col(place(c))).alias(c) for c in names]


def snapshot(spark: SparkSession, checkpoint: str, schema: StructType, ttl: bool = False) -> DataFrame:
    """The state of a keyed query after its last batch."""
    reader = spark.read.format("statestore").option("path", checkpoint)
    if ttl:
        return reader.option("stateVarName", STATE).load().select(*[F.col(f"value.value.{c}").alias(c) for c in schema.fieldNames()])
    rows = reader.load()
    key, value = rows.schema["key"].dataType, rows.schema["value"].dataType
    # The aggregation's only field is the place of the row and the row.
    order = [c for c in value[0].dataType.names if c not in (BATCH, REST)]
    return rows.select(*_columns(schema.fieldNames(), key.names, order, lambda c: F.col(f"key.`{c}`"), f"value.`{value.names[0]}`"))
