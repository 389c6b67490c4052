"""Dedup against the whole history, beyond any watermark.

Every stored id is marked in a Bloom filter of its month: the id's bucket, and ``HASHES`` bits of the bucket's bitmap. An incoming
id that no month's filter knows is new, without a look at the history. The others are compared with
the ids of the months whose filter knows them, and only those: an exact anti join, so a false positive costs a comparison
and loses nothing. Filters are rows (month, bucket, bitmap), built and merged by Spark's bitmap functions; a batch
adds a slice of the bits of its own new ids.

Rows without an id cannot repeat one and are kept. Of one id in a batch the earliest row stays. A replayed batch looks at
earlier batches only and writes the same again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.functions.times import month_key
from cargolens.streaming import slices

#: Bits of a bitmap (fixed by Spark's bitmap functions) and bits set per id.
BITS, HASHES = 32768, 4
#: Buckets of a month: 1024 hold 3 million ids at about one false positive in a hundred; set it in proportion to a month's ids.
BUCKETS = 1024
#: Spark's folder name for a null partition value: the month of ids without a time.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class SeenTables:
    root: str

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    @property
    def filters(self) -> str:
        return f"{self.root}/filters"

    @property
    def fresh(self) -> str:
        return f"{self.root}/_fresh"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def places(key: Column) -> Column:
    """Bit numbers of an id in the bitmap of its bucket."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BITS)).cast("int") for k in range(1, HASHES + 1)])


def filters_of(ids: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(month, bucket, bits)`` of the rows ``(id, month)``."""
    bits = ids.select("month", bucket(F.col("id"), buckets).alias("bucket"), F.explode(places(F.col("id"))).alias("place"))
    # The functions number bits from 1: the place of a value in its bitmap is that of the value plus one.
    return bits.groupBy("month", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"))


def known(bits: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1


def maybe(ids: DataFrame, filters: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(id, month)`` for each month that may hold an id; all that do are among them."""
    merged = filters.groupBy("month", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = ids.select("id", bucket(F.col("id"), buckets).alias("bucket"), places(F.col("id")).alias("places"))
    hits = asked.join(merged, "bucket").where(F.forall("places", lambda p: known(F.col("bits"), p)))
    return hits.select("id", "month")


def _months(spark: SparkSession, path: str, months: Sequence[str], schema, batch_id: int) -> DataFrame | None:
    """Rows of earlier batches in some months of a table by month and batch."""
    found = [f"{path}/event_month={m}" for m in months if slices.exists(spark, f"{path}/event_month={m}")]
    if not found:
        return None
    rows = spark.read.schema(schema).option("basePath", path).parquet(*found)
    return rows.where(F.col("batch") < batch_id)


def first_of_each(rows: DataFrame, key: str, time: str) -> DataFrame:
    """The earliest row of every id; rows without an id stay."""
    rest = [c for c in rows.columns if c not in (key, time)]
    down = Window.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in [time, *rest]])
    return rows.where(F.col(key).isNotNull()).withColumn("_place", F.row_number().over(down)).where("_place = 1").drop("_place").unionByName(
        rows.where(F.col(key).isNull())
    )


def unseen(rows: DataFrame, tables: SeenTables, batch_id: int, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows whose id no earlier batch has stored; ``rows`` holds an id once."""
    spark = rows.sparkSession
    stored = slices.folder_values(spark, tables.filters, "event_month")
    if not stored:
        return rows
    ids = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"))
    schema = "bucket int, bits binary, event_month string, batch long"
    filters = _months(spark, tables.filters, stored, schema, batch_id).withColumnRenamed("event_month", "month")
    hits = maybe(ids, filters, buckets)
    asked = [r[0] or NO_MONTH for r in hits.select("month").distinct().collect()]  # months: as many as the retention has
    id_type = rows.schema[key].dataType.simpleString()
    history = _months(spark, tables.history, sorted(asked), f"`{key}` {id_type}, event_month string, batch long", batch_id)
    if history is None:
        return rows
    # Only the ids that a filter knows are looked for; the history is read for its key, in the months asked.
    repeated = history.select(F.col(key).alias("id")).join(hits.select("id").distinct(), "id", "left_semi").distinct()
    return rows.join(repeated, F.col(key) == F.col("id"), "left_anti")


def write_batch(rows: DataFrame, batch_id: int, tables: SeenTables, key: str, time: str, buckets: int = BUCKETS, sort: Sequence[str] = ()) -> None:
    """Store the rows of a micro-batch whose id is new, then mark the ids."""
    spark = rows.sparkSession
    fresh = slices.hold(unseen(first_of_each(rows, key, time), tables, batch_id, key, buckets), tables.fresh, batch_id)
    slices.write_month_slice(fresh, tables.history, batch_id, time, sort)
    ids = fresh.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), month_key(F.col(time)).alias("month"))
    marked = filters_of(ids, buckets).withColumnRenamed("month", "event_month").withColumn("batch", F.lit(batch_id))
    (
        marked.hint("rebalance", "event_month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month", "batch")
        .parquet(tables.filters)
    )
    slices.release(spark, tables.fresh, batch_id)


def read_history(spark: SparkSession, tables: SeenTables) -> DataFrame:
    return spark.read.parquet(tables.history).drop("event_month", "batch")
