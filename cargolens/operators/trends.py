"""Rollups and operational reports beyond the serving views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.geo import haversine_km, leg, place, to_leg_km
from cargolens.functions.numbers import mean, ratio_or_zero
from cargolens.operators.events import delay_rate


def trend(enriched: DataFrame, grain: str) -> DataFrame:
    """Delivery KPI per day, week (from Monday) or month, rebuilt from the events."""
    dated = enriched.withColumn("period", F.to_date(F.date_trunc(grain, F.col("event_timestamp"))))
    totals = dated.groupBy("period").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("is_completed").alias("completed_deliveries"),
        F.sum("is_delayed").alias("delayed_deliveries"),
        mean(dated, "delay_minutes").alias("avg_delay_minutes"),
        F.sum("order_value").alias("total_order_value"),
    )
    decided = F.greatest(F.lit(1), F.col("completed_deliveries") + F.col("delayed_deliveries"))
    return totals.withColumn("delay_rate", F.col("delayed_deliveries") / decided)


def trends(enriched: DataFrame, grains: Sequence[str] = ("day", "week", "month")) -> DataFrame:
    """Delivery KPI of several grains from one pass over the events: a row per ``grain`` and ``period``.

    Each task adds its events up per grain before the shuffle, so what travels is a row per period and task. Events
    without a time are a period of every grain, as in ``trend``.
    """
    start = lambda g: F.to_date(F.date_trunc(g, F.col("event_timestamp"))).alias(g)
    dated = enriched.select(*[start(g) for g in grains], "is_completed", "is_delayed", "delay_minutes", "order_value")
    grouped = dated.groupingSets([[g] for g in grains], *grains).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("is_completed").alias("completed_deliveries"),
        F.sum("is_delayed").alias("delayed_deliveries"),
        mean(dated, "delay_minutes").alias("avg_delay_minutes"),
        F.sum("order_value").alias("total_order_value"),
        *[F.grouping(g).alias(f"without_{g}") for g in grains],
    )
    named = F.coalesce(*[F.when(F.col(f"without_{g}") == 0, F.lit(g)) for g in grains]).alias("grain")
    decided = F.greatest(F.lit(1), F.col("completed_deliveries") + F.col("delayed_deliveries"))
    figures = ("event_count", "completed_deliveries", "delayed_deliveries", "avg_delay_minutes", "total_order_value")
    return grouped.select(named, F.coalesce(*grains).alias("period"), *figures, (F.col("delayed_deliveries") / decided).alias("delay_rate"))


def cost_trend(gold_kpi: DataFrame, grain: str) -> DataFrame:
    """Cost per period from the route-day KPI; ratios again from sums."""
    dated = gold_kpi.withColumn("period", F.to_date(F.date_trunc(grain, F.col("business_date"))))
    totals = dated.groupBy("period").agg(
        F.sum("actual_cost").alias("actual_cost"),
        F.sum("planned_cost").alias("planned_cost"),
        F.sum("total_deliveries").alias("total_deliveries"),
    )
    actual = F.col("actual_cost").cast("double")
    return totals.withColumns(
        {
            "cost_variance": (F.col("actual_cost") - F.col("planned_cost")).cast("double"),
            "cost_per_delivery": ratio_or_zero(actual, F.col("total_deliveries").cast("double")),
        }
    )


def vehicle_utilization_daily(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("business_date", "vehicle_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("delivery_id").alias("delivery_count"),
        F.avg("utilization_ratio").alias("avg_utilization_ratio"),
        F.max("utilization_ratio").alias("max_utilization_ratio"),
    )


def _performance(enriched: DataFrame, *keys: str) -> DataFrame:
    return enriched.groupBy("business_date", *keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("is_completed").alias("completed_deliveries"),
        F.sum("is_delayed").alias("delayed_deliveries"),
        mean(enriched, "delay_minutes").alias("avg_delay_minutes"),
        delay_rate().alias("delay_rate"),
        mean(enriched, "planned_distance_km").alias("avg_distance_km"),
        F.sum("order_value").alias("total_order_value"),
    )


def route_performance_daily(enriched: DataFrame) -> DataFrame:
    return _performance(enriched, "route_id")


def warehouse_performance_daily(enriched: DataFrame) -> DataFrame:
    return _performance(enriched, "warehouse_id", "region")


def delivery_delay_analysis(enriched: DataFrame) -> DataFrame:
    """Delay by the conditions that may explain it."""
    return enriched.groupBy("region", "traffic_condition", "weather_condition").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("is_delayed").alias("delayed_event_count"),
        mean(enriched, "delay_minutes").alias("avg_delay_minutes"),
        F.max("delay_minutes").alias("max_delay_minutes"),
        delay_rate().alias("delay_rate"),
    )


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def delivery_durations(events: DataFrame) -> DataFrame:
    """Per region: deliveries, total planned distance, mean time from first to last event.

    The distance of a delivery is the largest planned distance any of its events
    names, so repeated events do not add kilometres; its region is the smallest name.
    """
    per_delivery = events.groupBy("delivery_id").agg(
        F.min("region").alias("region"),
        F.max("planned_distance_km").alias("distance_km"),
        seconds_between(F.min("event_timestamp"), F.max("event_timestamp")).alias("duration_seconds"),
    )
    return per_delivery.groupBy("region").agg(
        F.count(F.lit(1)).alias("delivery_count"),
        F.sum("distance_km").alias("total_distance_km"),
        mean(per_delivery, "duration_seconds").alias("avg_duration_seconds"),
    )


def active_deliveries(state: DataFrame) -> DataFrame:
    """Deliveries not yet delivered, by region and status."""
    return (
        state.filter(F.col("status") != "DELIVERED")
        .groupBy("region", "status")
        .agg(F.count(F.lit(1)).alias("delivery_count"), F.sum("package_count").alias("package_count"))
    )


def active_vehicle_workload(state: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Open deliveries and packages per active vehicle; idle active vehicles show zeros."""
    load = (
        state.filter(F.col("status") != "DELIVERED")
        .groupBy("vehicle_id")
        .agg(F.count(F.lit(1)).alias("open_deliveries"), F.sum("package_count").alias("open_packages"))
    )
    active = vehicles.filter("active").select("vehicle_id", "vehicle_type")
    return active.join(load, "vehicle_id", "left").fillna(0, subset=["open_deliveries", "open_packages"])


def top_routes(view: DataFrame, metric: str, k: int, aggregate: Column) -> DataFrame:
    """The k routes with the greatest metric; ties resolve by route id."""
    return view.groupBy("route_id").agg(aggregate.alias(metric)).orderBy(F.desc(metric), F.asc("route_id")).limit(k)


def planned_vs_actual(plans: DataFrame, events: DataFrame) -> DataFrame:
    """Each plan beside the first departure and the first confirmed arrival, if any."""
    observed = events.groupBy("delivery_id").agg(
        F.min(F.when(F.col("status") == "VEHICLE_DEPARTED", F.col("event_timestamp"))).alias("actual_departure_at"),
        F.min(F.when(F.col("status") == "DELIVERED", F.col("event_timestamp"))).alias("actual_arrival_at"),
    )
    return plans.join(observed, "delivery_id", "left").withColumns(
        {
            "departure_delay_seconds": seconds_between(F.col("planned_departure_at"), F.col("actual_departure_at")),
            "arrival_delay_seconds": seconds_between(F.col("planned_arrival_at"), F.col("actual_arrival_at")),
            "planned_duration_seconds": seconds_between(F.col("planned_departure_at"), F.col("planned_arrival_at")),
            "actual_duration_seconds": seconds_between(F.col("actual_departure_at"), F.col("actual_arrival_at")),
        }
    )


def source_trace(orders: DataFrame, shipments: DataFrame, plans: DataFrame) -> DataFrame:
    """Order to shipment to delivery plan."""
    return (
        orders.select("order_id")
        .join(shipments.select("order_id", "shipment_id"), "order_id")
        .join(plans.select("shipment_id", "delivery_id", "driver_id"), "shipment_id")
        .select("order_id", "shipment_id", "delivery_id", "driver_id")
    )


def delay_signals(
    state: DataFrame, warehouses: DataFrame, *, delayed_after_minutes: int, deviation_km: float, speed_kmh: float
) -> DataFrame:
    """Open deliveries with their delay, distance from the depot, simple ETA and flags.

    Every threshold is the caller's choice. The route model is the straight line from
    the warehouse: a vehicle deviates when it is further from its depot than the
    planned distance allows, and the ETA assumes the rest at a constant speed.
    """
    depot = warehouses.select(
        "warehouse_id", F.col("latitude").cast("double").alias("_lat"), F.col("longitude").cast("double").alias("_lon")
    )
    km = haversine_km(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    late_minutes = seconds_between(F.col("planned_arrival_timestamp"), F.col("estimated_arrival_timestamp")) / 60
    left_km = F.greatest(F.col("planned_distance_km") - F.col("depot_km"), F.lit(0.0))
    return (
        state.filter(F.col("status") != "DELIVERED")
        .join(depot, "warehouse_id", "left")
        .withColumn("depot_km", F.round(km, 3))
        .withColumn("arrival_delay_minutes", late_minutes)
        .withColumn("eta_minutes", left_km / speed_kmh * 60)
        .withColumn("is_late", F.coalesce((late_minutes >= delayed_after_minutes).cast("int"), F.lit(0)))
        .withColumn(
            "is_off_route",
            F.coalesce((F.col("depot_km") > F.col("planned_distance_km") + deviation_km).cast("int"), F.lit(0)),
        )
        .select(
            "delivery_id", "vehicle_id", "route_id", "status", "arrival_delay_minutes", "depot_km", "eta_minutes",
            "is_late", "is_off_route",
        )
    )


def problem_shipments(signals: DataFrame) -> DataFrame:
    return signals.filter((F.col("is_late") == 1) | (F.col("is_off_route") == 1))


def route_deviation(positions: DataFrame, stops: DataFrame, deviation_km: float) -> DataFrame:
    """Positions of planned deliveries with their distance from the planned way and whether it exceeds the limit.

    ``stops`` are the planned coordinates (delivery_id, stop, latitude, longitude); the way goes straight from stop to stop. Nothing
    is rounded before it is compared. A delivery with one stop is measured from that; without stops, or without a
    position, the distance is null and the position does not count as off the route.
    """
    # A delivery's stops are few; positions meet them as one array and are not multiplied. What a leg has of its own is computed
    # once per delivery, what a position has once per row, and only the rest for each pair.
    point = F.struct("stop", "latitude", "longitude")
    ways = stops.groupBy("delivery_id").agg(F.array_sort(F.collect_list(point)).alias("_stops"))
    ways = ways.select("delivery_id", F.transform("_stops", lambda s: place(s["latitude"], s["longitude"])).alias("_places"))
    legs = F.when(F.size("_places") == 1, F.transform("_places", lambda a: leg(a, a))).otherwise(
        F.transform(
            F.slice("_places", F.lit(1), F.size("_places") - 1),
            lambda a, i: leg(a, F.get(F.col("_places"), (i + 1).cast("int"))),
        )
    )
    ways = ways.select("delivery_id", legs.alias("_legs"))
    placed = positions.join(ways, "delivery_id", "left").withColumn("_place", place(F.col("latitude"), F.col("longitude")))
    far = F.transform("_legs", lambda g: to_leg_km(F.col("_place"), g))
    measured = placed.withColumn("deviation_km", F.array_min(far)).drop("_legs", "_place")
    return measured.withColumn("is_off_route", F.coalesce((F.col("deviation_km") > deviation_km).cast("int"), F.lit(0)))
