"""JSON wire text to typed rows, with the unusable rows set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.functions.text import has_text, lenient_double, lenient_int, text_or
from cargolens.functions.times import parse_time
from cargolens.sources.schemas import DELIVERY_EVENT_V1, VEHICLE_TELEMETRY_V1, Contract, Field

CORRUPT = "_corrupt"


def _decode(values: DataFrame, contract: Contract) -> DataFrame:
    """Adds the struct ``e`` with text leaves and the boolean ``is_corrupt``."""
    schema = T.StructType([*contract.wire_schema().fields, T.StructField(CORRUPT, T.StringType())])
    decoded = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return values.withColumn("e", decoded).withColumn(
        "is_corrupt", F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull()
    )


def parse_delivery_events(values: DataFrame) -> DataFrame:
    """Flat delivery events beside their untouched JSON in ``raw_event``.

    Missing optional text becomes '' and a missing number 0; a missing status falls
    back to the event type. Numbers given as text are accepted. Ids stay null when
    absent or JSON null, so that ``is_valid`` and the quarantine see them.
    """
    rows = _decode(values, DELIVERY_EVENT_V1)

    def top(name: str) -> Column:
        return F.col(f"e.{name}")

    def inner(name: str) -> Column:
        return F.col(f"e.payload.{name}")

    def whole(value: Column) -> Column:
        return F.coalesce(lenient_int(value), F.lit(0))

    def real(value: Column) -> Column:
        return F.coalesce(lenient_double(value), F.lit(0.0))

    fields = {
        "schema_version": whole(top("schema_version")),
        "event_id": top("event_id"),
        "event_type": text_or(top("event_type")),
        "event_timestamp": parse_time(top("event_timestamp")),
        "delivery_id": text_or(top("delivery_id")),
        "shipment_id": text_or(top("shipment_id")),
        "order_id": text_or(top("order_id")),
        "vehicle_id": text_or(top("vehicle_id")),
        "driver_id": text_or(top("driver_id")),
        "warehouse_id": text_or(top("warehouse_id")),
        "route_id": text_or(top("route_id")),
        "region": text_or(inner("region")),
        "status": F.coalesce(inner("status"), top("event_type"), F.lit("")),
        "latitude": real(inner("latitude")),
        "longitude": real(inner("longitude")),
        "planned_arrival_timestamp": parse_time(inner("planned_arrival_timestamp")),
        "estimated_arrival_timestamp": parse_time(inner("estimated_arrival_timestamp")),
        "delay_minutes": whole(inner("delay_minutes")),
        "capacity_used": real(inner("capacity_used")),
        "capacity_total": real(inner("capacity_total")),
        "service_level": text_or(inner("service_level")),
        "priority": text_or(inner("priority")),
        "customer_id": text_or(inner("customer_id")),
        "destination_city": text_or(inner("destination_city")),
        "package_count": whole(inner("package_count")),
        "order_value": real(inner("order_value")),
        "payment_method": text_or(inner("payment_method")),
        "planned_distance_km": real(inner("planned_distance_km")),
        "traffic_condition": text_or(inner("traffic_condition")),
        "weather_condition": text_or(inner("weather_condition")),
    }
    return rows.select(
        *[value.alias(name) for name, value in fields.items()], F.col("value").alias("raw_event"), "is_corrupt"
    )


def is_valid_delivery() -> Column:
    """Admission of a parsed delivery event; an event without a time has no version."""
    return (
        ~F.col("is_corrupt")
        & (F.col("schema_version") == 1)
        & has_text(F.col("event_id"))
        & F.col("event_timestamp").isNotNull()
    )


def _typed(item: Field) -> Column:
    value = F.col(f"e.{item.name}")
    if item.date_time:
        return parse_time(value)
    if item.type == "integer":
        return lenient_int(value)
    return lenient_double(value) if item.type == "number" else value


def parse_telemetry(values: DataFrame) -> DataFrame:
    """Typed telemetry; a missing or ill-typed field is null, ``is_corrupt`` marks non-JSON."""
    rows = _decode(values, VEHICLE_TELEMETRY_V1)
    return rows.select(
        *[_typed(item).alias(item.name) for item in VEHICLE_TELEMETRY_V1.fields], "value", "is_corrupt"
    )


def delivery_json(events: DataFrame, source: str) -> DataFrame:
    """Flat delivery events as nested wire JSON in a ``value`` column."""

    def wire(item: Field) -> Column:
        name = item.name.split(".")[-1]
        if item.date_time:
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias(name)
        return (F.lit(source) if name == "source" else F.col(name)).alias(name)

    top = [wire(item) for item in DELIVERY_EVENT_V1.fields if "." not in item.name]
    payload = [wire(item) for item in DELIVERY_EVENT_V1.fields if "." in item.name]
    return events.select(F.to_json(F.struct(*top, F.struct(*payload).alias("payload"))).alias("value"))


def telemetry_json(telemetry: DataFrame) -> DataFrame:
    columns = [
        F.date_format(item.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(item.name) if item.date_time else item.name
        for item in VEHICLE_TELEMETRY_V1.fields
    ]
    return telemetry.select(F.to_json(F.struct(*columns)).alias("value"))
