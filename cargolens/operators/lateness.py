"""Late data of a whole table: rows whose event time lies behind what had been taken in before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.session import shared_dir


def lateness(rows: DataFrame, order: Sequence[str], time: str = "event_timestamp", ranges: int | None = None) -> DataFrame:
    """``rows`` with ``lag_seconds``: how far each lies behind the newest event time before it, in ``order``; 0 where it does not.

    The running maximum goes over the whole table. Rows are dealt to ranges of the order and written; each range is
    ordered by itself, and the newest time of all ranges before it is carried over its border. A moment that
    fills many rows is split by the rest of the order, which must be total for a defined result. Rows without an event
    time have no lag and move no maximum.
    """
    spark = rows.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_first(c) for c in order]
    path = shared_dir(spark, "ingestion-order")
    ranged = rows.repartitionByRange(count, *keys).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    # One row per range; what a range is told of the earlier ones is a single time.
    tops = ranged.groupBy("_range").agg(F.max(time).alias("_top"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select("_range", F.max("_top").over(earlier).alias("_carried"))
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    newest = F.greatest(F.max(time).over(inside), F.col("_carried"))
    lag = (F.unix_micros(newest.cast("timestamp")) - F.unix_micros(F.col(time).cast("timestamp"))) / 1e6
    found = ranged.join(carried, "_range").withColumn("lag_seconds", F.when(F.col(time).isNotNull(), F.greatest(F.coalesce(lag, F.lit(0.0)), F.lit(0.0))))
    return found.drop("_range", "_carried")


def late_by_hour(measured: DataFrame, allowed_seconds: float, time: str = "event_timestamp") -> DataFrame:
    """Per hour of event time: rows, late rows and the worst lag."""
    return measured.groupBy(F.date_trunc("hour", F.col(time)).alias("event_hour")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("lag_seconds") > allowed_seconds).alias("late_count"),
        F.max("lag_seconds").alias("worst_lag_seconds"),
    )
