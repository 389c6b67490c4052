"""Every operator as a query over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.functions.times import month_key
from cargolens.operators import bi, contract, costs, integrity, latest, lifecycle, parse, quality, trends
from cargolens.operators import events as ev
from cargolens.operators import telemetry as tm
from cargolens.plans import fleet_sql, maintained
from cargolens.plans.compared import DIGITS
from cargolens.session import shared_dir, tune
from cargolens.plans.jobs import relationship_counts
from cargolens.sources import adapters, tables
from cargolens.sources.metadata import load_folder
from cargolens.sources.schemas import (
    COST_UPDATE_COLUMNS,
    DELIVERY_EVENT_V1,
    EVENT_COLUMNS,
    STATUS_ORDER,
    VEHICLE_TELEMETRY_V1,
)
from cargolens.streaming import delivery, fleet, slices
from cargolens.streaming.run import dedup, drain

Query = Callable[[SparkSession, str], DataFrame]

BATCH_DATE = date(1998, 9, 2)
RETENTION_AS_OF = datetime(2001, 11, 1)
TELEMETRY_AS_OF = datetime(2024, 1, 31)
COST_HIGH_WATER = datetime(2000, 6, 1)
#: A choice in each of the cost dashboard's filters.
DASHBOARD_SELECTIONS = {
    "region": ["EUROPE", "MIDDLE EAST"],
    "warehouse_id": ["warehouse-3", "warehouse-6", "warehouse-9", "warehouse-13", "warehouse-19"],
    "route_id": ["route-EUROPE-0", "route-EUROPE-1", "route-MIDDLE EAST-0", "route-MIDDLE EAST-5"],
}
SERVICE_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TOP_K = 10

DATASETS = load_folder(Path(__file__).resolve().parents[2] / "datasets")
COST_QUALITY = DATASETS["delivery.transportation_costs"].quality
TELEMETRY_QUALITY = DATASETS["fleet.vehicle_telemetry"].quality


def serving(df: DataFrame) -> DataFrame:
    """Serving types: money and ratios as double, UTC times without a zone."""
    casts = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}
    return df.select(
        *[F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else f.name for f in df.schema]
    )


# -- inputs ---------------------------------------------------------------------

STATE_INPUT = [*EVENT_COLUMNS, "planned_arrival_timestamp", "estimated_arrival_timestamp"]


def _events(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return adapters.delivery_events(spark, sf, columns or None)


def _view(name: str) -> Query:
    return lambda spark, sf: adapters.view(spark, sf, name)


_costs, _telemetry = _view("transportation_costs"), _view("vehicle_telemetry")
_orders, _shipments, _plans = _view("customer_orders"), _view("shipments"), _view("delivery_plans")
_vehicles, _warehouses = _view("vehicles"), _view("warehouses")


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return ev.enrich(adapters.delivery_events(spark, sf, [c for c in EVENT_COLUMNS if c not in adapters.EVENT_ORDER_COLUMNS]))


def _admitted(spark: SparkSession, sf: str) -> DataFrame:
    return tm.admit(_telemetry(spark, sf))


def _bronze(spark: SparkSession, sf: str, batch_date: date | None = None) -> DataFrame:
    rows = lifecycle.for_date(_costs(spark, sf), batch_date)
    return costs.bronze(rows, run_id="run", source_system="driver-tables", batch_date=batch_date)


def _gold(spark: SparkSession, sf: str, batch_date: date | None = None) -> DataFrame:
    return costs.gold(costs.silver(_bronze(spark, sf, batch_date)))


def _delivery_state(spark: SparkSession, sf: str) -> DataFrame:
    return ev.delivery_state(_events(spark, sf, *STATE_INPUT))


# -- delivery events --------------------------------------------------------------


def daily_delivery_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return ev.daily_kpi(_enriched(spark, sf))


def daily_delivery_kpi_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The option that counts a repeated event id once."""
    return ev.daily_kpi(ev.dedup_events(_enriched(spark, sf)))


def bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    return ev.bronze_events(ev.enrich(_events(spark, sf, *EVENT_COLUMNS)))


def vehicle_current_state(spark: SparkSession, sf: str) -> DataFrame:
    return ev.vehicle_state(
        _events(
            spark, sf, "event_id", "event_timestamp", "vehicle_id", "delivery_id", "route_id", "latitude", "longitude",
            "status", "capacity_used", "capacity_total", "traffic_condition", "weather_condition",
        )
    )


def status_overview(spark: SparkSession, sf: str) -> DataFrame:
    return ev.status_overview(_events(spark, sf, "status", "delivery_id", "delay_minutes"))


def delay_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return ev.delay_by_region(_events(spark, sf, "region", "service_level", "delay_minutes"))


def vehicle_utilization(spark: SparkSession, sf: str) -> DataFrame:
    return ev.vehicle_utilization(vehicle_current_state(spark, sf))


def warehouse_daily_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return ev.warehouse_daily_kpi(daily_delivery_kpi(spark, sf))


def event_volume(spark: SparkSession, sf: str) -> DataFrame:
    return ev.event_volume(_events(spark, sf, "event_timestamp", "event_type", "region", "delivery_id"))


def route_delay(spark: SparkSession, sf: str) -> DataFrame:
    return ev.route_delay(
        _events(spark, sf, "event_timestamp", "warehouse_id", "region", "route_id", "delivery_id", "delay_minutes")
    )


# -- transportation cost ----------------------------------------------------------


def cost_silver(spark: SparkSession, sf: str) -> DataFrame:
    return costs.silver(_bronze(spark, sf)).drop("_ingested_at")  # the moment of the run


def cost_gold_for_date(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf, BATCH_DATE)


def cost_performance(spark: SparkSession, sf: str) -> DataFrame:
    return costs.cost_performance(_gold(spark, sf), route_delay(spark, sf))


def cost_gold_table(spark: SparkSession, sf: str) -> DataFrame:
    """Serving KPI table: a full run and a later run of one date over corrected rows, merged by version on read."""
    root = shared_dir(spark, "gold") + "/kpi"
    corrected = costs.gold(costs.silver(_bronze(spark, sf, BATCH_DATE).filter(F.col("used_capacity") > 10)))
    for version, gold in ((1, _gold(spark, sf)), (2, corrected)):
        kpi = serving(gold).withColumns(
            {"version": F.lit(version), "month": month_key(F.col("business_date"))}
        )
        arranged = tables.arrange(kpi, "month", tables.SORT_KEYS["daily_transportation_cost_kpi"])
        arranged.write.mode("append").partitionBy("month").parquet(root)
    rows = spark.read.parquet(root)
    return latest.latest_by_key(rows, ev.ROUTE_KEYS, ["version"]).drop("version", "month")


# -- quality and integrity ----------------------------------------------------------


def quality_cost(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failed_counts(_costs(spark, sf), quality.rules(COST_QUALITY))


def quality_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failed_counts(_telemetry(spark, sf), quality.rules(TELEMETRY_QUALITY))


def source_checks(spark: SparkSession, sf: str) -> DataFrame:
    return (
        quality.failed_counts(_costs(spark, sf), quality.source_checks())
        .unionByName(quality.failed_counts(_orders(spark, sf), quality.order_checks()))
        .unionByName(quality.failed_counts(_plans(spark, sf), quality.plan_checks()))
        .unionByName(quality.failed_counts(_vehicles(spark, sf), quality.vehicle_checks()))
    )


def event_checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failed_counts(_events(spark, sf), quality.event_checks(STATUS_ORDER))


def relationships_cost(spark: SparkSession, sf: str) -> DataFrame:
    parents = {
        "public.delivery_plans": _plans(spark, sf),
        "public.vehicles": _vehicles(spark, sf),
        "public.warehouses": _warehouses(spark, sf),
    }
    return relationship_counts(_costs(spark, sf), DATASETS["delivery.transportation_costs"], parents)


def event_cost_coverage(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["delivery_id", "route_id", "vehicle_id", "warehouse_id", "region"]
    return integrity.coverage(_events(spark, sf, *keys), _costs(spark, sf), keys)


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.duplicate_keys(_events(spark, sf, "event_id"), ["event_id"])


def duplicate_cost_keys(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.duplicate_keys(_costs(spark, sf), ["cost_id"])


def duplicate_plates(spark: SparkSession, sf: str) -> DataFrame:
    """Plate numbers and ids of the vehicle table that occur more than once."""
    vehicles = _vehicles(spark, sf)
    checks = [
        integrity.duplicate_keys(vehicles.select(F.lit(c).alias("key_column"), F.col(c).alias("key_value")), ["key_column", "key_value"])
        for c in ("vehicle_id", "plate_number")
    ]
    return checks[0].unionByName(checks[1])


def duplicate_confirmations(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.duplicate_confirmations(_events(spark, sf, "delivery_id", "status"))


def events_before_shipment(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf, "event_id", "shipment_id", "event_timestamp", "status")
    return integrity.events_before_creation(events, _shipments(spark, sf))


def arrivals_before_departure(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.arrivals_before_departure(_events(spark, sf, "delivery_id", "status", "event_timestamp"))


def status_transitions(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["delivery_id", "event_timestamp", "event_id", "vehicle_id", "route_id", "status"]
    return integrity.status_transitions(_events(spark, sf, *columns), STATUS_ORDER)


def contract_split(spark: SparkSession, sf: str) -> DataFrame:
    return contract.reason_counts(_telemetry(spark, sf), VEHICLE_TELEMETRY_V1)


def contract_split_json(spark: SparkSession, sf: str) -> DataFrame:
    """The delivery contract over the wire JSON, extra and missing fields included."""
    values = parse.delivery_json(adapters.delivery_events_dealt(spark, sf), "driver-tables")
    decoded = values.select("value", F.from_json("value", DELIVERY_EVENT_V1.wire_schema()).alias("e"))
    return contract.reason_counts(decoded, DELIVERY_EVENT_V1, root="e", raw="value")


# -- telemetry ------------------------------------------------------------------------


def telemetry_raw(spark: SparkSession, sf: str) -> DataFrame:
    return tm.raw(_admitted(spark, sf))


def fleet_current_state(spark: SparkSession, sf: str) -> DataFrame:
    return tm.fleet_state(_admitted(spark, sf))


def health_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return tm.health_alerts(_admitted(spark, sf))


def health_alerts_sql(spark: SparkSession, sf: str) -> DataFrame:
    return fleet_sql.run("alerts", _telemetry(spark, sf))


def vehicle_extremes_sql(spark: SparkSession, sf: str) -> DataFrame:
    return fleet_sql.run("vehicle_extremes", _telemetry(spark, sf))


def fleet_metrics_5m(spark: SparkSession, sf: str) -> DataFrame:
    return tm.fleet_metrics(_admitted(spark, sf))


# -- streams --------------------------------------------------------------------------


def _telemetry_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry through its wire form: JSON text, parsed again as the stream would."""
    rows = adapters.view(spark, sf, "vehicle_telemetry", streaming="events")
    return fleet.telemetry_stream(parse.telemetry_json(rows))


def fleet_metrics_5m_stream(spark: SparkSession, sf: str) -> DataFrame:
    return drain(spark, fleet.window_metrics(_telemetry_stream(spark, sf)), "fleet-metrics")


def health_alerts_stream(spark: SparkSession, sf: str) -> DataFrame:
    return drain(spark, tm.health_alerts(tm.admit(_telemetry_stream(spark, sf))), "health-alerts")


def telemetry_raw_stream(spark: SparkSession, sf: str) -> DataFrame:
    return drain(spark, tm.raw(tm.admit(_telemetry_stream(spark, sf))), "telemetry-raw")


def telemetry_dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarked stream dedup by event id; every seventh event comes three times."""
    rows = adapters.view(spark, sf, "vehicle_telemetry", streaming="events")
    copies = F.when(F.col("event_id").cast("long") % 7 == 0, 3).otherwise(1)
    repeated = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    marked = fleet.watermarked(tm.admit(fleet.telemetry_stream(parse.telemetry_json(repeated))))
    return drain(spark, tm.raw(dedup(marked, "event_id")), "telemetry-dedup")


def _drained_fleet(spark: SparkSession, sf: str) -> fleet.FleetTables:
    out = fleet.FleetTables(shared_dir(spark, "fleet"))
    rows = adapters.view(spark, sf, "vehicle_telemetry", streaming="events")
    for query in fleet.start(parse.telemetry_json(rows), out, once=True):
        query.awaitTermination()
    return out


def fleet_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.read_state(spark, _drained_fleet(spark, sf))


def _drained_delivery(spark: SparkSession, sf: str) -> delivery.DeliveryTables:
    out = delivery.DeliveryTables(shared_dir(spark, "delivery"))
    arriving = f"{out.root}/arriving"
    rows = adapters.delivery_event_stream(spark, sf, arriving)
    with adapters.file_per_task(spark):
        queries = delivery.start(parse.delivery_json(rows, "driver-tables"), out, once=True, gather=False)
    for query in queries:
        query.awaitTermination()
    slices.remove(spark, arriving)
    return out


def delivery_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.read_delivery_state(spark, _drained_delivery(spark, sf))


def vehicle_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.read_vehicle_state(spark, _drained_delivery(spark, sf))


def delivery_history_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event history the stream wrote, as the daily KPI reads it."""
    history = delivery.read_history(spark, _drained_delivery(spark, sf))
    return ev.daily_kpi(ev.enrich(history))


def json_parse_events(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_delivery_events(parse.delivery_json(adapters.delivery_events_dealt(spark, sf), "driver-tables")).drop("raw_event")


# -- BI -----------------------------------------------------------------------------------

VIEWS: dict[str, Query] = {
    "status_overview": status_overview,
    "delay_by_region": delay_by_region,
    "vehicle_utilization": vehicle_utilization,
    "warehouse_daily_kpi": warehouse_daily_kpi,
    "event_volume": event_volume,
    "cost_performance": cost_performance,
}


def _chart(name: str) -> Query:
    spec = bi.CHARTS[name]
    pivot = SERVICE_LEVELS if spec.columns == "service_level" else None
    return lambda spark, sf: bi.chart(VIEWS[spec.view](spark, sf), spec, pivot_values=pivot)


def bi_cost_per_delivery_avg(spark: SparkSession, sf: str) -> DataFrame:
    spec = bi.CHARTS["cost_per_delivery"]
    return bi.chart(cost_performance(spark, sf), spec, aggregates={"cost_per_delivery": "avg"})


def bi_route_cost_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The chart as a dashboard shows it: its first rows only."""
    return bi.chart(cost_performance(spark, sf), bi.CHARTS["route_cost"], limit=bi.ROW_LIMIT)


def _cost_charts() -> dict[str, bi.Chart]:
    return {name: bi.CHARTS[name] for name in bi.DASHBOARDS["cost_and_routes"][0]}


def bi_cost_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """All charts of the cost dashboard from one pass over its view."""
    return bi.dashboard(cost_performance(spark, sf), _cost_charts())


def bi_cost_dashboard_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The same under the dashboard's four filters."""
    view = bi.apply_filters(cost_performance(spark, sf), start=date(1996, 1, 1), end=date(2006, 1, 1), selections=DASHBOARD_SELECTIONS)
    return bi.dashboard(view, _cost_charts())


def bi_filtered_cost(spark: SparkSession, sf: str) -> DataFrame:
    view = bi.apply_filters(
        cost_performance(spark, sf),
        start=date(1997, 1, 1),
        end=date(1998, 1, 1),
        selections={"region": ["ASIA", "EUROPE"], "warehouse_id": [], "route_id": []},
    )
    return bi.chart(view, bi.CHARTS["route_cost"])


# -- tables by key, lifecycle ------------------------------------------------------------


COST_ORDER = ["updated_at", "vehicle_id", "route_id"]


def _cost_feed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Current cost rows, and a feed that revises heavy loads and adds their return trips.

    The feed repeats keys: an older version of every revision comes after it. Rows are dealt by their key once, for the table and the
    changes of known keys; only the return trips are dealt again, by their new keys.
    """
    rows = _costs(spark, sf).repartition("cost_id")
    kinds = lambda *names: F.explode(F.when(F.col("used_capacity") > 25, F.array(*[F.lit(n) for n in names])))
    revised, returned = F.col("_kind") == "revised", F.col("_kind") == "return"
    money = "decimal(12,2)"
    known = rows.withColumn("_kind", kinds("revised", "stale"))
    trips = _costs(spark, sf).withColumn("_kind", kinds("return")).withColumn("cost_id", F.concat(F.lit("return-"), "cost_id"))
    feed = known.unionByName(trips.repartition("cost_id")).withColumns(
        {
            "region": F.when(returned, F.col("region")).otherwise(F.lit("not an updated column")),
            "other_cost": F.when(revised, F.col("other_cost") + 5).otherwise(F.col("other_cost")).cast(money),
            "actual_total_cost": F.when(revised, F.col("actual_total_cost") + 5)
            .otherwise(F.col("actual_total_cost"))
            .cast(money),
            "updated_at": F.when(revised, F.col("updated_at") + F.expr("INTERVAL '1' DAY")).otherwise(F.col("updated_at")),
        }
    ).drop("_kind")
    return latest.latest_by_key(rows, ["cost_id"], COST_ORDER), feed


def upsert_cost(spark: SparkSession, sf: str) -> DataFrame:
    base, changes = _cost_feed(spark, sf)
    return latest.upsert(base, changes, ["cost_id"], COST_UPDATE_COLUMNS, COST_ORDER, few=False)


def insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Plan stubs for the deliveries that have events but no plan yet."""
    seen = _events(spark, sf, "delivery_id", "shipment_id", "vehicle_id", "driver_id", "route_id", "event_timestamp")
    return latest.insert_absent(_plans(spark, sf), seen, ["delivery_id"], ["event_timestamp", "vehicle_id", "route_id"])


def retention_events(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf, "event_id", "event_timestamp", "delivery_id", "vehicle_id", "route_id")
    return lifecycle.retain(events, RETENTION_AS_OF, 30)


def history_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Event history written by month and read back: rows and keys per month partition."""
    root = shared_dir(spark, "history") + "/events"
    events = _events(spark, sf, "event_id", "event_timestamp", "delivery_id")
    dated = events.withColumn("event_month", F.date_format("event_timestamp", "yyyyMM"))
    arranged = tables.arrange(dated, "event_month", tables.SORT_KEYS["delivery_events"])
    arranged.write.partitionBy("event_month").parquet(root)
    return (
        spark.read.parquet(root)
        .groupBy(F.col("event_month").cast("int").alias("event_month"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("event_id").alias("event_count"))
    )


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.freshness(_telemetry(spark, sf), "event_timestamp", TELEMETRY_AS_OF, DATASETS["fleet.vehicle_telemetry"].max_lag_seconds)


def source_readiness(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.readiness(_costs(spark, sf), BATCH_DATE)


def incremental_cost(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.incremental(_costs(spark, sf), "updated_at", COST_HIGH_WATER)


def source_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).select("order_id", "service_level", "order_value").orderBy("order_id").limit(10)


# -- rollups and reports ------------------------------------------------------------------


def _trend(grain: str) -> Query:
    return lambda spark, sf: trends.trend(_enriched(spark, sf), grain)


def cost_trend_month(spark: SparkSession, sf: str) -> DataFrame:
    return trends.cost_trend(_gold(spark, sf), "month")


def source_trace(spark: SparkSession, sf: str) -> DataFrame:
    return trends.source_trace(_orders(spark, sf), _shipments(spark, sf), _plans(spark, sf))


def planned_vs_actual(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf, "delivery_id", "status", "event_timestamp")
    return trends.planned_vs_actual(_plans(spark, sf), events)


def top_delayed_routes(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf, "route_id", "delay_minutes")
    return trends.top_routes(events, "total_delay_minutes", TOP_K, F.sum("delay_minutes"))


def top_cost_routes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _costs(spark, sf)
    return trends.top_routes(rows, "actual_cost", TOP_K, F.sum("actual_total_cost"))


def delivery_durations(spark: SparkSession, sf: str) -> DataFrame:
    return trends.delivery_durations(_events(spark, sf, "delivery_id", "region", "planned_distance_km", "event_timestamp"))


def active_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return trends.active_deliveries(_delivery_state(spark, sf))


def active_vehicle_workload(spark: SparkSession, sf: str) -> DataFrame:
    return trends.active_vehicle_workload(_delivery_state(spark, sf), _vehicles(spark, sf))


def delay_signals(spark: SparkSession, sf: str) -> DataFrame:
    return trends.delay_signals(
        _delivery_state(spark, sf), _warehouses(spark, sf), delayed_after_minutes=15, deviation_km=5.0, speed_kmh=40.0
    )


def problem_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return trends.problem_shipments(delay_signals(spark, sf))


_BUILDERS: dict[str, Query] = {
    "daily_delivery_kpi": daily_delivery_kpi,
    "daily_delivery_kpi_dedup": daily_delivery_kpi_dedup,
    "bronze_events": bronze_events,
    "delivery_current_state": _delivery_state,
    "vehicle_current_state": vehicle_current_state,
    "status_overview": status_overview,
    "delay_by_region": delay_by_region,
    "vehicle_utilization": vehicle_utilization,
    "warehouse_daily_kpi": warehouse_daily_kpi,
    "event_volume": event_volume,
    "route_delay": route_delay,
    "cost_silver": cost_silver,
    "cost_gold": _gold,
    "cost_gold_for_date": cost_gold_for_date,
    "cost_gold_table": cost_gold_table,
    "cost_performance": cost_performance,
    "quality_cost": quality_cost,
    "quality_telemetry": quality_telemetry,
    "source_checks": source_checks,
    "event_checks": event_checks,
    "relationships_cost": relationships_cost,
    "event_cost_coverage": event_cost_coverage,
    "duplicate_keys": duplicate_keys,
    "duplicate_cost_keys": duplicate_cost_keys,
    "duplicate_plates": duplicate_plates,
    "duplicate_confirmations": duplicate_confirmations,
    "events_before_shipment": events_before_shipment,
    "arrivals_before_departure": arrivals_before_departure,
    "status_transitions": status_transitions,
    "contract_split": contract_split,
    "contract_split_json": contract_split_json,
    "json_parse_events": json_parse_events,
    "telemetry_raw": telemetry_raw,
    "fleet_current_state": fleet_current_state,
    "health_alerts": health_alerts,
    "health_alerts_sql": health_alerts_sql,
    "vehicle_extremes_sql": vehicle_extremes_sql,
    "fleet_metrics_5m": fleet_metrics_5m,
    "fleet_metrics_5m_stream": fleet_metrics_5m_stream,
    "health_alerts_stream": health_alerts_stream,
    "telemetry_raw_stream": telemetry_raw_stream,
    "telemetry_dedup_stream": telemetry_dedup_stream,
    "fleet_state_stream": fleet_state_stream,
    "delivery_state_stream": delivery_state_stream,
    "vehicle_state_stream": vehicle_state_stream,
    "delivery_history_stream": delivery_history_stream,
    **{f"bi_{name}": _chart(name) for name in bi.CHARTS},
    "bi_cost_per_delivery_avg": bi_cost_per_delivery_avg,
    "bi_filtered_cost": bi_filtered_cost,
    "bi_cost_dashboard": bi_cost_dashboard,
    "bi_cost_dashboard_filtered": bi_cost_dashboard_filtered,
    "bi_route_cost_limited": bi_route_cost_limited,
    "upsert_cost": upsert_cost,
    "insert_absent": insert_absent,
    "retention_events": retention_events,
    "history_layout": history_layout,
    "freshness": freshness,
    "source_readiness": source_readiness,
    "incremental_cost": incremental_cost,
    "source_sample": source_sample,
    "source_trace": source_trace,
    "planned_vs_actual": planned_vs_actual,
    "trends_all": lambda spark, sf: trends.trends(_enriched(spark, sf)),
    "trend_day": _trend("day"),
    "trend_week": _trend("week"),
    "trend_month": _trend("month"),
    "cost_trend_month": cost_trend_month,
    "vehicle_utilization_daily": lambda spark, sf: trends.vehicle_utilization_daily(_enriched(spark, sf)),
    "route_performance_daily": lambda spark, sf: trends.route_performance_daily(_enriched(spark, sf)),
    "warehouse_performance_daily": lambda spark, sf: trends.warehouse_performance_daily(_enriched(spark, sf)),
    "delivery_delay_analysis": lambda spark, sf: trends.delivery_delay_analysis(_enriched(spark, sf)),
    "delivery_durations": delivery_durations,
    "top_delayed_routes": top_delayed_routes,
    "top_cost_routes": top_cost_routes,
    "active_deliveries": active_deliveries,
    "active_vehicle_workload": active_vehicle_workload,
    "delay_signals": delay_signals,
    "problem_shipments": problem_shipments,
    **maintained.QUERIES,
}


def _served(name: str, build: Query) -> Query:
    """Results in serving types, their summed doubles rounded as ``compared`` says."""
    digits = DIGITS.get(name, {})
    return lambda spark, sf: serving(build(tune(spark), sf)).withColumns({c: F.round(c, n) for c, n in digits.items()})


def registry() -> dict[str, Query]:
    return {name: _served(name, build) for name, build in _BUILDERS.items()}
