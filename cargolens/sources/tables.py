"""Lake tables: write modes, layout, publishing, upsert and maintenance."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.latest import insert_absent, upsert
from cargolens.operators.lifecycle import for_date

MODES = ("create_or_replace", "overwrite_partitions", "append")

# Sort key of each serving table, and the time its month partition uses.
SORT_KEYS: dict[str, tuple[str, ...]] = {
    "delivery_events": ("delivery_id", "event_timestamp", "event_id"),
    "delivery_current_state": ("delivery_id",),
    "vehicle_current_state": ("vehicle_id",),
    "daily_delivery_kpi": ("business_date", "region", "warehouse_id"),
    "daily_transportation_cost_kpi": ("business_date", "warehouse_id", "region", "route_id"),
    "vehicle_telemetry_events": ("vehicle_id", "event_timestamp", "event_id"),
    "fleet_current_state": ("vehicle_id",),
    "vehicle_health_alerts": ("alert_type", "vehicle_id", "event_timestamp", "event_id"),
    "vehicle_metrics_5m": ("window_start",),
}


def namespace_of(name: str) -> str:
    """Catalog and namespace of a ``catalog.namespace.table`` name."""
    parts = name.split(".")
    if len(parts) < 3 or not all(parts):
        raise ValueError(f"expected catalog.namespace.table, got {name!r}")
    return ".".join(parts[:-1])


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace_of(name)}")


def write_mode(batch_date: date | None) -> str:
    """A dated run replaces the partitions it touches, an undated one the whole table."""
    return "overwrite_partitions" if batch_date else "create_or_replace"


def arrange(df: DataFrame, partition: str | None, sort: Sequence[str] = ()) -> DataFrame:
    """Cluster rows for a partitioned write, sorted inside each file.

    ``rebalance`` gathers the rows of a partition value, packs small values together
    and splits a value that is too large for one task, whatever its rows look like.
    """
    if partition:
        df = df.hint("rebalance", partition)
    order = list(dict.fromkeys([*([partition] if partition else []), *sort]))
    return df.sortWithinPartitions(*order) if order else df


def _replace_partitions(df: DataFrame, name: str) -> None:
    """Dynamic partition overwrite of an existing file table."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(key, before)


def write_table(
    df: DataFrame,
    name: str,
    *,
    partition: str | None = None,
    mode: str = "create_or_replace",
    provider: str = "parquet",
    table_exists: bool | None = None,
) -> None:
    """Write a lake table. ``overwrite_partitions`` creates a table that is not there yet.

    Iceberg goes through the V2 writer. The session catalog's file tables only take
    the V1 path, where dynamic partition overwrite gives the same result.
    """
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; expected one of {', '.join(MODES)}")
    exists = df.sparkSession.catalog.tableExists(name) if table_exists is None else table_exists
    if provider == "iceberg":
        writer = df.writeTo(name).using("iceberg")
        if mode == "append":
            writer.append()
        elif mode == "overwrite_partitions" and exists:
            writer.overwritePartitions()
        else:
            (writer.partitionedBy(F.col(partition)) if partition else writer).createOrReplace()
        return
    if exists and mode == "append":
        df.select(*df.sparkSession.table(name).columns).write.insertInto(name)
    elif exists and mode == "overwrite_partitions":
        _replace_partitions(df, name)
    else:
        writer = df.write.format(provider).mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


def publish(df: DataFrame, columns: Sequence[str], save) -> int:
    """Write the named columns, in order, through ``save(writer)``; returns the row count.

    Executors write straight to the target and the count is observed on the way, so
    nothing passes through the driver and the plan runs once.
    """
    seen = Observation()
    chosen = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    save(chosen.write)
    return int(seen.get["rows"])


def to_jdbc(options: Mapping[str, str], table: str):
    """``save`` for a JDBC serving table. A retry after a failure may insert a row twice;
    the serving table merges rows of one key by version, so readers see one."""
    return lambda writer: writer.format("jdbc").options(**options, dbtable=table).mode("append").save()


def to_parquet(path: str, mode: str = "overwrite"):
    return lambda writer: writer.mode(mode).parquet(path)


def require_published(published: DataFrame, batch_date: date, what: str) -> int:
    """Post-publish check: the target holds rows of the date."""
    count = for_date(published, batch_date).count()
    if count == 0:
        raise RuntimeError(f"{what} has no rows for {batch_date.isoformat()}")
    return count


def round_trip(spark: SparkSession, name: str) -> DataFrame:
    """Lake smoke job: create, insert, filter and read back one row."""
    ensure_namespace(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id INT, message STRING) USING parquet")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'lake-ok')")
    found = spark.sql(f"SELECT id, message FROM {name} WHERE id = 1")
    if found.isEmpty():
        raise RuntimeError(f"{name} returned no rows after the insert")
    return found


def _touched(base: DataFrame, changes: DataFrame, keys: Sequence[str], partition: str) -> list:
    """Partition values an upsert rewrites: where known keys live, and where new rows go.

    The list is as long as the calendar of the changes, not as the data.
    """
    known = base.select(*keys, partition).join(changes.select(*keys), list(keys), "left_semi").select(partition)
    return [row[0] for row in known.union(changes.select(partition)).distinct().collect()]


def upsert_table(
    spark: SparkSession,
    name: str,
    changes: DataFrame,
    *,
    keys: Sequence[str],
    update: Sequence[str],
    version: Sequence[str],
    partition: str,
) -> int:
    """Upsert into a partitioned file table, rewriting only the touched partitions.

    The merged partitions are first written to a staging table; it stays until the
    swap has committed, so a swap that broke off can be finished with ``finish_swap``.
    Returns the number of partitions rewritten.
    """
    base = spark.table(name)
    values = _touched(base, changes, keys, partition)
    if not values:
        return 0
    # ``partition`` is not among the updated columns: a known key stays where it is.
    merged = upsert(base.filter(F.col(partition).isin(values)), changes, keys, update, version)
    staging = f"{name}__swap_{uuid.uuid4().hex[:8]}"
    merged.select(*base.columns).write.format("parquet").partitionBy(partition).saveAsTable(staging)
    finish_swap(spark, name, staging)
    return len(values)


def finish_swap(spark: SparkSession, name: str, staging: str) -> None:
    """Replace the staged partitions in the table; safe to repeat until it succeeds."""
    _replace_partitions(spark.table(staging), name)
    spark.sql(f"DROP TABLE {staging}")


def append_absent(spark: SparkSession, name: str, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> None:
    """Insert-if-absent into a table."""
    base = spark.table(name)
    insert_absent(base, new, keys, order).select(*base.columns).write.insertInto(name)


def compact_partition(spark: SparkSession, name: str, partition: str, value: object, files: int, sort: Sequence[str] = ()) -> None:
    """Rewrite one partition into ``files`` sorted files through a staging table."""
    rows = spark.table(name).filter(F.col(partition) == F.lit(value))
    staging = f"{name}__swap_{uuid.uuid4().hex[:8]}"
    packed = rows.repartition(files).sortWithinPartitions(*sort) if sort else rows.repartition(files)
    packed.write.format("parquet").partitionBy(partition).saveAsTable(staging)
    finish_swap(spark, name, staging)


def drop_expired_months(spark: SparkSession, name: str, partition: str, as_of: datetime, days: int = 30) -> list[str]:
    """Drop whole expired month partitions of a managed history table; metadata work only."""
    limit = (as_of - timedelta(days=days)).strftime("%Y%m")
    months = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    expired = sorted(m for m in months if m < limit)
    for month in expired:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition}='{month}')")
    return expired
