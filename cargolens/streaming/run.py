"""Pieces every stream shares: dedup, progress figures and a drain into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolens.session import shared_dir


def drain(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Append-mode run over everything available; exactly-once through the file sink's log."""
    root = shared_dir(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def spread(values: DataFrame, tasks: int | None) -> DataFrame:
    """Deal the raw messages out to ``tasks`` tasks before they are parsed.

    For a source with fewer partitions than the cluster has cores: parsing JSON is the
    heaviest step of a stream. Rows are dealt round-robin, so no key can crowd a task.
    """
    return values.repartition(tasks) if tasks else values


def dedup(stream: DataFrame, key: str, salts: int = 8) -> DataFrame:
    """Drop repeated keys within the watermark.

    All copies of a key meet in one task. With ``salts`` they first meet in up to that
    many tasks, by the input partition they came from, and only one copy of each goes
    on; a key with very many copies is thinned out before its single task. The price is
    a second state entry per key; ``salts=1`` leaves it out.
    """
    if salts > 1:
        salted = stream.withColumn("_salt", F.spark_partition_id() % salts)
        stream = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return stream.dropDuplicatesWithinWatermark([key])


def late_rows(query: StreamingQuery) -> int:
    """Rows the recent batches of a query dropped behind the watermark."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
