"""Delivery events: enrichment, daily KPI, latest state and the BI views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.numbers import mean
from cargolens.functions.times import as_event_time, epoch_millis, epoch_seconds
from cargolens.operators.latest import latest_by_key
from cargolens.sources.schemas import BRONZE_EVENT_COLUMNS, DELIVERY_STATE_COLUMNS, VEHICLE_STATE_COLUMNS

# Breaks ties between events of one key at the same instant.
EVENT_TIES = ["event_id", "vehicle_id", "route_id"]
KPI_KEYS = ["business_date", "region", "warehouse_id"]
ROUTE_KEYS = ["business_date", "warehouse_id", "region", "route_id"]


def is_delayed() -> Column:
    """1 for a positive delay; a null delay counts as on time."""
    return F.coalesce((F.col("delay_minutes") > 0).cast("int"), F.lit(0))


def utilization() -> Column:
    """Used over total capacity; 0.0 without a positive total."""
    share = F.col("capacity_used").cast("double") / F.col("capacity_total").cast("double")
    return F.when(F.col("capacity_total") > 0, share).otherwise(F.lit(0.0))


def enrich(events: DataFrame) -> DataFrame:
    events = as_event_time(events)
    return events.withColumns(
        {
            "business_date": F.to_date("event_timestamp"),
            "is_completed": F.coalesce((F.col("status") == "DELIVERED").cast("int"), F.lit(0)),
            "is_delayed": is_delayed(),
            "utilization_ratio": utilization(),
        }
    )


def daily_kpi(enriched: DataFrame) -> DataFrame:
    """Daily KPI over every event, repeated ones included.

    Both rates share the denominator completed + delayed (at least 1), so the
    on-time rate of a day without either may exceed 1.
    """
    kpi = enriched.groupBy(*KPI_KEYS).agg(
        F.sum("is_completed").alias("completed_deliveries"),
        F.sum("is_delayed").alias("delayed_deliveries"),
        F.count_if(F.col("is_delayed") == 0).alias("on_time_deliveries"),
        mean(enriched, "delay_minutes").alias("avg_delay_minutes"),
        F.avg("utilization_ratio").alias("avg_vehicle_utilization"),
        F.sum("order_value").alias("total_order_value"),
        F.sum("package_count").alias("total_package_count"),
        mean(enriched, "planned_distance_km").alias("avg_distance_km"),
    )
    decided = F.greatest(F.lit(1), F.col("completed_deliveries") + F.col("delayed_deliveries"))
    return kpi.withColumns(
        {
            "delay_rate": F.col("delayed_deliveries") / decided,
            "on_time_rate": F.col("on_time_deliveries") / decided,
        }
    )


def stamp(kpi: DataFrame, published_at: Column) -> DataFrame:
    """Publish time and, from it, the version a replacing table merges by."""
    return kpi.withColumns({"published_at": published_at, "version": epoch_seconds(published_at)})


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per ``event_id``; the reference keeps any, this keeps the latest."""
    events = as_event_time(events)
    return latest_by_key(events, ["event_id"], ["event_timestamp", "vehicle_id", "route_id"])


def bronze_events(enriched: DataFrame) -> DataFrame:
    return dedup_events(enriched.select(*BRONZE_EVENT_COLUMNS))


def delivery_projection(events: DataFrame) -> DataFrame:
    """Event to delivery-state row; its version is the event time in milliseconds."""
    return events.withColumns(
        {
            "is_delayed": is_delayed(),
            "utilization_ratio": utilization(),
            "last_event_id": F.col("event_id"),
            "last_event_timestamp": F.col("event_timestamp"),
            "version": epoch_millis(F.col("event_timestamp")),
        }
    ).select(*DELIVERY_STATE_COLUMNS)


def vehicle_projection(events: DataFrame) -> DataFrame:
    """Event to vehicle-state row; carries the tie-breaking event id in ``_event_id``."""
    return events.select(
        *[
            {
                "active_status": F.col("status").alias("active_status"),
                "utilization_ratio": utilization().alias("utilization_ratio"),
                "last_event_timestamp": F.col("event_timestamp").alias("last_event_timestamp"),
                "version": epoch_millis(F.col("event_timestamp")).alias("version"),
            }.get(name, F.col(name))
            for name in VEHICLE_STATE_COLUMNS
        ],
        F.col("event_id").alias("_event_id"),
    )


DELIVERY_STATE_ORDER = ["version", "last_event_timestamp", "last_event_id", "vehicle_id", "route_id"]
VEHICLE_STATE_ORDER = ["version", "last_event_timestamp", "_event_id", "route_id"]


def delivery_state(events: DataFrame) -> DataFrame:
    return latest_by_key(delivery_projection(events), ["delivery_id"], DELIVERY_STATE_ORDER)


def vehicle_state(events: DataFrame) -> DataFrame:
    return latest_by_key(vehicle_projection(events), ["vehicle_id"], VEHICLE_STATE_ORDER).drop("_event_id")


def delay_rate() -> Column:
    return F.count_if(F.col("delay_minutes") > 0) / F.greatest(F.count(F.lit(1)), F.lit(1))


def status_overview(events: DataFrame) -> DataFrame:
    return events.groupBy("status").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("delivery_id").alias("delivery_count"),
        mean(events, "delay_minutes").alias("avg_delay_minutes"),
    )


def delay_by_region(events: DataFrame) -> DataFrame:
    return events.groupBy("region", "service_level").agg(
        F.count(F.lit(1)).alias("event_count"),
        mean(events, "delay_minutes").alias("avg_delay_minutes"),
        delay_rate().alias("delay_rate"),
    )


def vehicle_utilization(state: DataFrame) -> DataFrame:
    """Per vehicle over merged state: last status and route are those of the top version."""
    return state.groupBy("vehicle_id").agg(
        F.max_by("active_status", "version").alias("active_status"),
        F.max_by("route_id", "version").alias("route_id"),
        mean(state, "utilization_ratio").alias("avg_utilization_ratio"),
        F.max("last_event_timestamp").alias("last_seen_at"),
    )


def warehouse_daily_kpi(kpi: DataFrame) -> DataFrame:
    """Serving view of the KPI table: merged by version where it carries one."""
    merged = latest_by_key(kpi, KPI_KEYS, ["version"]) if "version" in kpi.columns else kpi
    return merged.drop("avg_delay_minutes", "published_at", "version")


def event_volume(events: DataFrame) -> DataFrame:
    return events.groupBy(
        F.date_trunc("hour", F.col("event_timestamp")).alias("event_hour"), "event_type", "region"
    ).agg(F.count(F.lit(1)).alias("event_count"), F.count_distinct("delivery_id").alias("delivery_count"))


def route_delay(events: DataFrame) -> DataFrame:
    dated = events.withColumn("business_date", F.to_date("event_timestamp"))
    return dated.groupBy(*ROUTE_KEYS).agg(
        F.count_distinct("delivery_id").alias("operational_delivery_count"),
        F.count_if(F.col("delay_minutes") > 0).alias("delayed_delivery_count"),
        mean(dated, "delay_minutes").alias("avg_delay_minutes"),
        delay_rate().alias("delay_rate"),
    )
