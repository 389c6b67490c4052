"""Event contracts and the column lists of the serving tables.

The enums, ranges, patterns and column orders are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One contract field; ``name`` may be a dotted path into a nested object."""

    name: str
    type: str = "string"
    required: bool = False
    const: object = None
    enum: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None
    exclusive_minimum: float | None = None
    pattern: str | None = None
    min_length: int | None = None
    date_time: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    extra_fields: bool = True
    required_objects: tuple[str, ...] = field(default=())

    def wire_schema(self) -> T.StructType:
        """Every leaf as text: a wrongly typed value must not lose the whole row."""
        top, nested = [], {}
        for item in self.fields:
            if "." in item.name:
                parent, child = item.name.split(".")
                if parent not in nested:
                    nested[parent] = []
                nested[parent].append(T.StructField(child, T.StringType()))
            else:
                top.append(T.StructField(item.name, T.StringType()))
        top += [T.StructField(parent, T.StructType(children)) for parent, children in nested.items()]
        return T.StructType(top)

    def top_level_names(self) -> list[str]:
        return list(dict.fromkeys(item.name.split(".")[0] for item in self.fields))


# Delivery event contract, version 1.
DELIVERY_EVENT_V1 = Contract(
    "delivery_event_v1",
    (
        Field("schema_version", "integer", required=True, const=1),
        Field("event_id", required=True, min_length=1),
        Field(
            "event_type",
            required=True,
            enum=("ORDER_LOADED", "VEHICLE_DEPARTED", "IN_TRANSIT", "DELIVERY_DELAYED", "DELIVERED"),
        ),
        Field("event_timestamp", required=True, date_time=True),
        Field("order_id"),
        Field("shipment_id"),
        Field("delivery_id", required=True),
        Field("vehicle_id", required=True),
        Field("driver_id"),
        Field("warehouse_id"),
        Field("route_id"),
        Field("source", required=True),
        Field("payload.status", required=True),
        Field("payload.latitude", "number", required=True, minimum=-90, maximum=90),
        Field("payload.longitude", "number", required=True, minimum=-180, maximum=180),
        Field("payload.region"),
        Field("payload.planned_arrival_timestamp", date_time=True),
        Field("payload.estimated_arrival_timestamp", date_time=True),
        Field("payload.delay_minutes", "integer"),
        Field("payload.capacity_used", "number", required=True, minimum=0),
        Field("payload.capacity_total", "number", required=True, exclusive_minimum=0),
        Field("payload.service_level"),
        Field("payload.priority"),
        Field("payload.customer_id"),
        Field("payload.destination_city"),
        Field("payload.package_count", "integer", minimum=1),
        Field("payload.order_value", "number", minimum=0),
        Field("payload.payment_method"),
        Field("payload.planned_distance_km", "number", minimum=0),
        Field("payload.traffic_condition"),
        Field("payload.weather_condition"),
    ),
    required_objects=("payload",),
)

# Vehicle telemetry contract, version 1.
VEHICLE_TELEMETRY_V1 = Contract(
    "vehicle_telemetry_v1",
    (
        Field("schema_version", "integer", required=True, const=1),
        Field("event_id", required=True, min_length=1),
        Field("event_type", required=True, const="VEHICLE_TELEMETRY"),
        Field("event_timestamp", required=True, date_time=True),
        Field("ingestion_timestamp", required=True, date_time=True),
        Field("vehicle_id", required=True, pattern="^VEH-[0-9]{3}$"),
        Field("driver_id", required=True, pattern="^DRV-[0-9]{3}$"),
        Field("latitude", "number", required=True, minimum=-90, maximum=90),
        Field("longitude", "number", required=True, minimum=-180, maximum=180),
        Field("speed_kmh", "number", required=True, minimum=0, maximum=180),
        Field("fuel_level_pct", "number", required=True, minimum=0, maximum=100),
        Field("engine_temperature_c", "number", required=True, minimum=-40, maximum=160),
        Field("odometer_km", "number", required=True, minimum=0),
        Field("engine_status", required=True, enum=("RUNNING", "IDLE", "OFF")),
        Field("vehicle_status", required=True, enum=("IN_TRANSIT", "IDLE", "MAINTENANCE", "OFFLINE")),
    ),
    extra_fields=False,
)

# Status order of one delivery's life.
STATUS_ORDER = ("ORDER_LOADED", "VEHICLE_DEPARTED", "IN_TRANSIT", "DELIVERY_DELAYED", "DELIVERED")

# Columns of the event history a batch job reads.
EVENT_COLUMNS = [
    "schema_version", "event_id", "event_type", "event_timestamp", "delivery_id", "shipment_id", "order_id",
    "vehicle_id", "driver_id", "route_id", "warehouse_id", "region", "status", "latitude", "longitude",
    "delay_minutes", "capacity_used", "capacity_total", "service_level", "priority", "customer_id",
    "destination_city", "package_count", "order_value", "payment_method", "planned_distance_km",
    "traffic_condition", "weather_condition",
]
BRONZE_EVENT_COLUMNS = [*EVENT_COLUMNS, "business_date"]

# Columns of the latest state per delivery and per vehicle.
DELIVERY_STATE_COLUMNS = [
    "delivery_id", "shipment_id", "order_id", "vehicle_id", "driver_id", "route_id", "warehouse_id", "region",
    "status", "latitude", "longitude", "planned_arrival_timestamp", "estimated_arrival_timestamp",
    "delay_minutes", "is_delayed", "capacity_used", "capacity_total", "utilization_ratio", "service_level",
    "priority", "customer_id", "destination_city", "package_count", "order_value", "payment_method",
    "planned_distance_km", "traffic_condition", "weather_condition", "last_event_id", "last_event_timestamp",
    "version",
]
VEHICLE_STATE_COLUMNS = [
    "vehicle_id", "delivery_id", "route_id", "latitude", "longitude", "active_status", "capacity_used",
    "capacity_total", "utilization_ratio", "traffic_condition", "weather_condition", "last_event_timestamp",
    "version",
]

# Published KPI columns, in serving order.
DAILY_KPI_COLUMNS = [
    "business_date", "region", "warehouse_id", "completed_deliveries", "delayed_deliveries",
    "on_time_deliveries", "delay_rate", "on_time_rate", "avg_delay_minutes", "avg_vehicle_utilization",
    "total_order_value", "total_package_count", "avg_distance_km", "published_at", "version",
]
COST_KPI_COLUMNS = [
    "business_date", "warehouse_id", "region", "route_id", "cost_record_count", "total_deliveries",
    "planned_cost", "actual_cost", "fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost",
    "total_distance_km", "avg_vehicle_utilization_pct", "avg_delivery_duration_minutes",
    "avg_duration_variance_minutes", "cost_variance", "cost_variance_pct", "cost_per_km", "cost_per_delivery",
    "fuel_cost_pct", "published_at", "version",
]

# Telemetry columns of the raw history and of the latest state.
TELEMETRY_COLUMNS = [item.name for item in VEHICLE_TELEMETRY_V1.fields]
FLEET_STATE_COLUMNS = [
    "vehicle_id", "event_id", "event_timestamp", "driver_id", "latitude", "longitude", "speed_kmh",
    "fuel_level_pct", "engine_temperature_c", "odometer_km", "engine_status", "vehicle_status",
]

# The measures a repeated cost row replaces.
COST_UPDATE_COLUMNS = [
    "actual_distance_km", "planned_cost", "fuel_cost", "driver_cost", "toll_cost", "maintenance_cost",
    "other_cost", "actual_total_cost", "fuel_liters", "delivery_count", "vehicle_capacity", "used_capacity",
    "planned_duration_minutes", "actual_duration_minutes", "updated_at",
]
