"""Batch and stream readers. They only declare a source; nothing runs until an action."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.sources.metadata import Dataset
from cargolens.sources.schemas import EVENT_COLUMNS


def partitioned_scan(column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    """JDBC options that split one table scan over executors by a column range.

    Without them a JDBC source is read by one task. The bounds only set the stride:
    rows outside them still arrive, in the first and last partition.
    """
    return {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def event_history_query(source_table: str) -> str:
    """The projecting subquery a JDBC read of the event history pushes to the database."""
    columns = ", ".join("toString(event_timestamp) AS event_timestamp" if c == "event_timestamp" else c for c in EVENT_COLUMNS)
    return f"(SELECT {columns} FROM {source_table}) AS delivery_events"


def read_event_history(
    spark: SparkSession, source_table: str, connection: Mapping[str, str], scan: Mapping[str, str] | None = None
) -> DataFrame:
    options = {**connection, "dbtable": event_history_query(source_table), **(scan or {})}
    return spark.read.format("jdbc").options(**options).load()


def jdbc_options(dataset: Dataset, connection: Mapping[str, str], scan: Mapping[str, str] | None = None) -> dict[str, str]:
    return {
        "driver": "org.postgresql.Driver",
        **connection,
        "dbtable": dataset.source_table,
        **(scan or {}),
    }


def read_dataset(
    spark: SparkSession,
    dataset: Dataset,
    connection: Mapping[str, str] | None = None,
    scan: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch source by ``source.type``: a PostgreSQL table, files, or a catalog table."""
    kind = dataset.source_type
    if kind == "postgres":
        return spark.read.format("jdbc").options(**jdbc_options(dataset, connection or {}, scan)).load()
    if kind in ("parquet", "orc", "json", "csv"):
        return spark.read.format(kind).options(**dataset.source.get("options", {})).load(dataset.source["path"])
    if kind == "table":
        return spark.table(dataset.source["table"])
    raise ValueError(f"{dataset.dataset_id}: no batch reader for source type {kind!r}")


def kafka_options(
    servers: str, topic: str, group: str | None = None, max_offsets: int | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_values(spark: SparkSession, servers: str, topic: str, **more: object) -> DataFrame:
    """Message values as text from the earliest offset (needs the Kafka connector jar)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **more))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_values(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One JSON document per line from a folder of text files."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_dataset(spark: SparkSession, dataset: Dataset, options: Mapping[str, str]) -> DataFrame:
    """Stream source by ``source.type``: Kafka in production, text files elsewhere."""
    if dataset.source_type == "kafka":
        return kafka_values(spark, options["servers"], str(dataset.source["topic"]), group=options.get("group"))
    if dataset.source_type == "text":
        return file_values(spark, dataset.source["path"])
    raise ValueError(f"{dataset.dataset_id}: no stream reader for source type {dataset.source_type!r}")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"source lacks columns: {', '.join(missing)}")
    return df.select(*columns)
