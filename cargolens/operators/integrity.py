"""Checks across rows and tables: keys, references and status sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_confirmations(events: DataFrame) -> DataFrame:
    return duplicate_keys(events.filter(F.col("status") == "DELIVERED"), ["delivery_id"])


def orphans(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(relationship, orphan_count): child rows whose reference has no parent.

    One scan of the child: its references are turned into (relationship, value) rows and counted per value
    before they meet the parents' keys, so a value that a third of the rows share reaches the join as
    one row. A null reference is not an orphan.
    """
    pair = lambda name, value: F.struct(F.lit(name).alias("relationship"), value.cast("string").alias("ref"))
    each = child.select(F.inline(F.array(*[pair(c, F.col(c)) for c in parents]))).filter(F.col("ref").isNotNull())
    counted = each.groupBy("relationship", "ref").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionByName, [parent.select(pair(c, F.col(key)).alias("k")).select("k.*") for c, (parent, key) in parents.items()])
    lost = counted.join(known, ["relationship", "ref"], "left_anti")
    totals = lost.agg(*[F.coalesce(F.sum(F.when(F.col("relationship") == c, F.col("n"))), F.lit(0)).cast("bigint").alias(f"n{i}") for i, c in enumerate(parents)])
    return totals.select(F.inline(F.array(*[F.struct(F.lit(c).alias("relationship"), F.col(f"n{i}").alias("orphan_count")) for i, c in enumerate(parents)])))


def coverage(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct key tuples, and rows, of ``child`` also occur in ``parent``."""
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = parent.select(*keys).distinct().withColumn("_seen", F.lit(1))
    return counted.join(seen, list(keys), "left").agg(
        F.count(F.lit(1)).alias("key_count"),
        F.count("_seen").alias("covered_key_count"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_seen").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("covered_row_count"),
    )


def events_before_creation(events: DataFrame, shipments: DataFrame) -> DataFrame:
    """Events that happened before their shipment was created."""
    created = shipments.select("shipment_id", F.col("created_at").alias("shipment_created_at"))
    joined = events.join(created, "shipment_id")
    return joined.filter(F.col("event_timestamp") < F.col("shipment_created_at"))


def arrivals_before_departure(events: DataFrame) -> DataFrame:
    """Deliveries confirmed before their first departure."""
    times = events.groupBy("delivery_id").agg(
        F.min(F.when(F.col("status") == "VEHICLE_DEPARTED", F.col("event_timestamp"))).alias("departed_at"),
        F.min(F.when(F.col("status") == "DELIVERED", F.col("event_timestamp"))).alias("delivered_at"),
    )
    return times.filter(F.col("delivered_at") < F.col("departed_at"))


def with_previous(df: DataFrame, key: str, time: str, ties: Sequence[str], value: str, out: str, *, chunk: str = "hour") -> DataFrame:
    """``lag(value)`` per key in (time, ties) order, without one task per key.

    Rows are ordered within (key, time chunk). The first row of a chunk takes the last value of the key's previous
    non-empty chunk, found over the two border rows of each chunk, so a hot key costs a task its chunks, not its rows.
    """
    order = [F.col(c) for c in (time, *ties)]
    rows = df.withColumn("_chunk", F.date_trunc(chunk, F.col(time)))
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    placed = rows.withColumns({out: F.lag(value).over(inside), "_n": F.row_number().over(inside), "_last": F.lead(F.lit(True)).over(inside).isNull()})
    borders = placed.filter((F.col("_n") == 1) | F.col("_last"))
    carried = borders.withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_n") == 1)
    return placed.filter(F.col("_n") > 1).unionByName(carried).select(*df.columns, out)


def is_forward(previous: Column, current: Column, order: Sequence[str]) -> Column:
    """A delivery may start anywhere, repeat a status or move forward; DELIVERED is final."""
    steps = F.array(*[F.lit(s) for s in order])
    moves_on = F.array_position(steps, previous) <= F.array_position(steps, current)
    known = F.array_contains(steps, current) & (previous.isNull() | F.array_contains(steps, previous))
    return F.coalesce(known & (previous.isNull() | moves_on), F.lit(False))


def status_transitions(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """Counts of (previous status, status) pairs and whether the step is allowed."""
    steps = with_previous(
        events.select("delivery_id", "event_timestamp", "event_id", "vehicle_id", "route_id", "status"),
        "delivery_id",
        "event_timestamp",
        ["event_id", "vehicle_id", "route_id"],
        "status",
        "previous_status",
    )
    return (
        steps.groupBy(F.coalesce("previous_status", F.lit("")).alias("previous_status"), "status")
        .agg(F.count(F.lit(1)).alias("transition_count"))
        .withColumn(
            "is_allowed",
            is_forward(F.nullif(F.col("previous_status"), F.lit("")), F.col("status"), order).cast("int"),
        )
    )
