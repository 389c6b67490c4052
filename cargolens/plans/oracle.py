"""The SQL a reader can check each query against (DuckDB dialect)."""

from __future__ import annotations

from cargolens.operators.bi import ROW_LIMIT
from cargolens.plans.compared import DIGITS
from cargolens.sources import adapters
from cargolens.sources.schemas import COST_UPDATE_COLUMNS, EVENT_COLUMNS


def _plain(sql: str) -> str:
    """Adapter SQL with its ``{table}`` slots as plain table names."""
    return sql.replace("{", "").replace("}", "")


def iavg(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def isum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} <> 0 THEN ({n}) / ({d}) ELSE 0e0 END"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


_VIEWS = {"delivery_events": _plain(adapters.events_sql()[0])} | {
    name: _plain(sql) for name, (sql, _) in adapters.VIEWS.items()
}

UTILIZATION = "CASE WHEN capacity_total > 0 THEN capacity_used / capacity_total ELSE 0e0 END"
DELAY_RATE = "count(*) FILTER (delay_minutes > 0) / greatest(count(*), 1)"

_VIEWS["enriched"] = f"""
SELECT *, CAST(event_timestamp AS DATE) AS business_date,
       CASE WHEN status = 'DELIVERED' THEN 1 ELSE 0 END AS is_completed,
       CASE WHEN delay_minutes > 0 THEN 1 ELSE 0 END AS is_delayed,
       {UTILIZATION} AS utilization_ratio
FROM delivery_events"""
_VIEWS["unique_events"] = """
SELECT * FROM enriched
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC, vehicle_id DESC, route_id DESC) = 1"""


def _kpi(source: str) -> str:
    return f"""
SELECT *, delayed_deliveries / greatest(1, completed_deliveries + delayed_deliveries) AS delay_rate,
       on_time_deliveries / greatest(1, completed_deliveries + delayed_deliveries) AS on_time_rate
FROM (SELECT business_date, region, warehouse_id,
             {isum("is_completed")} AS completed_deliveries, {isum("is_delayed")} AS delayed_deliveries,
             count(*) FILTER (is_delayed = 0) AS on_time_deliveries,
             {iavg("delay_minutes")} AS avg_delay_minutes, avg(utilization_ratio) AS avg_vehicle_utilization,
             sum(order_value) AS total_order_value, {isum("package_count")} AS total_package_count,
             avg(planned_distance_km) AS avg_distance_km
      FROM {source} GROUP BY ALL)"""


_VIEWS["kpi"] = _kpi("enriched")
_VIEWS["delivery_state"] = f"""
SELECT * EXCLUDE (schema_version, event_type, event_id, event_timestamp),
       CASE WHEN delay_minutes > 0 THEN 1 ELSE 0 END AS is_delayed, {UTILIZATION} AS utilization_ratio,
       event_id AS last_event_id, event_timestamp AS last_event_timestamp, epoch_us(event_timestamp) // 1000 AS version
FROM delivery_events
QUALIFY row_number() OVER (PARTITION BY delivery_id
                           ORDER BY event_timestamp DESC, event_id DESC, vehicle_id DESC, route_id DESC) = 1"""
_VIEWS["vehicle_state"] = f"""
SELECT vehicle_id, delivery_id, route_id, latitude, longitude, status AS active_status, capacity_used, capacity_total,
       {UTILIZATION} AS utilization_ratio, traffic_condition, weather_condition,
       event_timestamp AS last_event_timestamp, epoch_us(event_timestamp) // 1000 AS version
FROM delivery_events
QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY event_timestamp DESC, event_id DESC, route_id DESC) = 1"""
_VIEWS["status_overview"] = f"""
SELECT status, count(*) AS event_count, count(DISTINCT delivery_id) AS delivery_count,
       {iavg("delay_minutes")} AS avg_delay_minutes
FROM delivery_events GROUP BY status"""
_VIEWS["delay_by_region"] = f"""
SELECT region, service_level, count(*) AS event_count, {iavg("delay_minutes")} AS avg_delay_minutes,
       {DELAY_RATE} AS delay_rate
FROM delivery_events GROUP BY ALL"""
_VIEWS["vehicle_utilization"] = """
SELECT vehicle_id, active_status, route_id,
       utilization_ratio AS avg_utilization_ratio,
       last_event_timestamp AS last_seen_at
FROM vehicle_state"""
_VIEWS["warehouse_daily_kpi"] = "SELECT * EXCLUDE (avg_delay_minutes) FROM kpi"
_VIEWS["event_volume"] = """
SELECT date_trunc('hour', event_timestamp) AS event_hour, event_type, region,
       count(*) AS event_count, count(DISTINCT delivery_id) AS delivery_count
FROM delivery_events GROUP BY ALL"""
_VIEWS["route_delay"] = f"""
SELECT CAST(event_timestamp AS DATE) AS business_date, warehouse_id, region, route_id,
       count(DISTINCT delivery_id) AS operational_delivery_count,
       count(*) FILTER (delay_minutes > 0) AS delayed_delivery_count,
       {iavg("delay_minutes")} AS avg_delay_minutes, {DELAY_RATE} AS delay_rate
FROM delivery_events GROUP BY ALL"""

ACTUAL, PLANNED = dbl("actual_total_cost"), dbl("planned_cost")
KM, PLANNED_KM = dbl("actual_distance_km"), dbl("planned_distance_km")
_VIEWS["cost_silver"] = f"""
SELECT *, {ACTUAL} - {PLANNED} AS cost_variance, {ratio(f"{ACTUAL} - {PLANNED}", PLANNED)} AS cost_variance_pct,
       {KM} - {PLANNED_KM} AS distance_variance_km, {ratio(f"{KM} - {PLANNED_KM}", PLANNED_KM)} AS distance_variance_pct,
       {dbl("actual_duration_minutes")} - planned_duration_minutes AS duration_variance_minutes,
       {ratio(ACTUAL, KM)} AS cost_per_km, {ratio(ACTUAL, dbl("delivery_count"))} AS cost_per_delivery,
       {ratio(dbl("fuel_cost"), ACTUAL)} AS fuel_cost_pct,
       {ratio(dbl("used_capacity"), dbl("vehicle_capacity"))} AS vehicle_utilization_pct
FROM transportation_costs"""


def _silver(source: str) -> str:
    return _VIEWS["cost_silver"].replace("FROM transportation_costs", f"FROM {source}")


def _gold(condition: str = "TRUE", source: str = "cost_silver") -> str:
    gap = dbl("actual_cost - planned_cost")
    return f"""
SELECT *, {gap} AS cost_variance, {ratio(gap, dbl("planned_cost"))} AS cost_variance_pct,
       {ratio(dbl("actual_cost"), dbl("total_distance_km"))} AS cost_per_km,
       {ratio(dbl("actual_cost"), dbl("total_deliveries"))} AS cost_per_delivery,
       {ratio(dbl("fuel_cost"), dbl("actual_cost"))} AS fuel_cost_pct
FROM (SELECT business_date, warehouse_id, region, route_id, count(DISTINCT cost_id) AS cost_record_count,
             {isum("delivery_count")} AS total_deliveries, sum(planned_cost) AS planned_cost,
             sum(actual_total_cost) AS actual_cost, sum(fuel_cost) AS fuel_cost, sum(driver_cost) AS driver_cost,
             sum(toll_cost) AS toll_cost, sum(maintenance_cost) AS maintenance_cost, sum(other_cost) AS other_cost,
             sum(actual_distance_km) AS total_distance_km,
             avg(vehicle_utilization_pct) AS avg_vehicle_utilization_pct,
             {iavg("actual_duration_minutes")} AS avg_delivery_duration_minutes,
             avg(duration_variance_minutes) AS avg_duration_variance_minutes
      FROM {source} WHERE {condition} GROUP BY ALL)"""


_VIEWS["cost_gold"] = _gold()
_VIEWS["corrected_gold"] = _gold("business_date = DATE '1998-09-02' AND used_capacity > 10")
_VIEWS["cost_performance"] = """
SELECT k.*, coalesce(d.operational_delivery_count, 0) AS operational_delivery_count,
       coalesce(d.delayed_delivery_count, 0) AS delayed_delivery_count,
       coalesce(d.avg_delay_minutes, 0) AS avg_delay_minutes, coalesce(d.delay_rate, 0) AS delay_rate,
       k.cost_variance_pct + coalesce(d.delay_rate, 0) AS cost_delay_risk_score
FROM cost_gold k LEFT JOIN route_delay d USING (business_date, warehouse_id, region, route_id)"""
_VIEWS["admitted"] = """
SELECT * FROM vehicle_telemetry WHERE schema_version = 1 AND event_type = 'VEHICLE_TELEMETRY'"""
_VIEWS["fleet_metrics"] = f"""
SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
       time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end,
       count(DISTINCT vehicle_id) AS active_vehicle_count, avg(speed_kmh) AS avg_speed_kmh,
       avg(fuel_level_pct) AS avg_fuel_level_pct, max(engine_temperature_c) AS max_engine_temperature_c,
       count(*) FILTER (speed_kmh >= 100) AS overspeed_vehicle_count,
       count(*) FILTER (fuel_level_pct <= 15) AS low_fuel_vehicle_count
FROM admitted GROUP BY ALL"""
_VIEWS["alerts"] = """
SELECT event_id, vehicle_id, event_timestamp,
       CASE WHEN engine_temperature_c >= 105 THEN 'ENGINE_TEMPERATURE_HIGH' WHEN fuel_level_pct <= 15 THEN 'LOW_FUEL'
            ELSE 'OVERSPEED' END AS alert_type,
       CASE WHEN engine_temperature_c >= 105 THEN 'critical' ELSE 'warning' END AS severity,
       CASE WHEN engine_temperature_c >= 105 THEN engine_temperature_c WHEN fuel_level_pct <= 15 THEN fuel_level_pct
            ELSE speed_kmh END AS observed_value,
       CASE WHEN engine_temperature_c >= 105 THEN 105e0 WHEN fuel_level_pct <= 15 THEN 15e0 ELSE 100e0 END AS threshold
FROM admitted WHERE engine_temperature_c >= 105 OR fuel_level_pct <= 15 OR speed_kmh >= 100"""
_VIEWS["fleet_state"] = """
SELECT vehicle_id, event_id, event_timestamp AS last_event_timestamp, driver_id, latitude, longitude, speed_kmh,
       fuel_level_pct, engine_temperature_c, odometer_km, engine_status, vehicle_status,
       epoch_us(event_timestamp) // 1000 AS version
FROM admitted
QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY event_timestamp DESC, event_id DESC) = 1"""
_VIEWS["current_costs"] = """
SELECT * FROM transportation_costs
QUALIFY row_number() OVER (PARTITION BY cost_id ORDER BY updated_at DESC, vehicle_id DESC, route_id DESC) = 1"""

_VIEWS["heavy_costs"] = """
SELECT * FROM transportation_costs WHERE used_capacity > 25
QUALIFY row_number() OVER (PARTITION BY cost_id ORDER BY updated_at DESC, vehicle_id DESC, route_id DESC) = 1"""

GOLD_MONEY = "planned_cost actual_cost fuel_cost driver_cost toll_cost maintenance_cost other_cost total_distance_km".split()
COST_DECIMALS = (
    "planned_distance_km actual_distance_km planned_cost fuel_cost driver_cost toll_cost maintenance_cost other_cost "
    "actual_total_cost fuel_liters vehicle_capacity used_capacity"
).split()


def _doubles(names: list[str]) -> str:
    return "REPLACE (" + ", ".join(f"{dbl(n)} AS {n}" for n in names) + ")"


AS_GOLD, AS_COST, AS_MONEY = _doubles(GOLD_MONEY), _doubles(COST_DECIMALS), _doubles(["total_order_value"])
AS_ORDER = _doubles(["order_value"])

_MOVED, _FIXED = "kind = 1", "kind IN (1, 2)"
_VIEWS["old_costs"] = """
SELECT *, CASE WHEN business_date >= DATE '1998-01-01' THEN delivery_count % 7 ELSE -1 END AS kind FROM current_costs"""
_VIEWS["new_costs"] = f"""
SELECT * EXCLUDE (kind) REPLACE (
         CAST(CASE WHEN {_MOVED} THEN business_date + INTERVAL '40' DAY ELSE business_date END AS DATE) AS business_date,
         CASE WHEN {_MOVED} THEN concat(route_id, '-b') ELSE route_id END AS route_id,
         CASE WHEN {_FIXED} THEN other_cost + 2 ELSE other_cost END AS other_cost,
         CASE WHEN {_FIXED} THEN actual_total_cost + 2 ELSE actual_total_cost END AS actual_total_cost)
FROM old_costs WHERE kind <> 0
UNION ALL SELECT * EXCLUDE (kind) REPLACE (concat('extra-', cost_id) AS cost_id) FROM old_costs WHERE kind = 3"""
_VIEWS["new_silver"] = _silver("new_costs")
_VIEWS["arrived"] = """
SELECT *, CAST(event_id AS BIGINT) % 3 AS part FROM admitted"""
_VIEWS["marks"] = """
SELECT p.part, (SELECT max(event_timestamp) FROM arrived a WHERE a.part < p.part) - INTERVAL '10 seconds' AS watermark
FROM (SELECT DISTINCT part FROM arrived) p"""


def _vector(lat: str, lon: str) -> list[str]:
    return [f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"]


def _arc(lat: str, lon: str, a: str, b: str) -> str:
    chord = f"pow(sin(radians({a} - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians({a})) * pow(sin(radians({b} - {lon}) / 2), 2)"
    return f"12742e0 * asin(sqrt(least({chord}, 1e0)))"


def _named(prefix: str, lat: str, lon: str) -> str:
    return ", ".join(f"{v} AS {prefix}{axis}" for v, axis in zip(_vector(lat, lon), "xyz"))


def _turn(a: str, b: str) -> list[str]:
    return [f"({a}y * {b}z - {a}z * {b}y)", f"({a}z * {b}x - {a}x * {b}z)", f"({a}x * {b}y - {a}y * {b}x)"]


def _onto_pole(parts: list[str]) -> str:
    return " + ".join(f"{v} * n{axis}" for v, axis in zip(parts, "xyz"))


_VIEWS["legs"] = f"""
SELECT *, {", ".join(f"{v} AS n{axis}" for v, axis in zip(_turn("f", "g"), "xyz"))} FROM (
  SELECT *, {_named("f", "alat", "alon")}, {_named("g", "blat", "blon")} FROM (
    SELECT delivery_id, latitude AS alat, longitude AS alon, lead(latitude) OVER w AS blat, lead(longitude) OVER w AS blon
    FROM planned_stops WINDOW w AS (PARTITION BY delivery_id ORDER BY stop)) WHERE blat IS NOT NULL)"""
_VIEWS["leg_distances"] = f"""
SELECT event_row, CASE WHEN nx * nx + ny * ny + nz * nz > 0 AND {_onto_pole(_turn("f", "p"))} >= 0 AND {_onto_pole(_turn("p", "g"))} >= 0
       THEN 6371e0 * asin(abs({_onto_pole(["px", "py", "pz"])}) / sqrt(nx * nx + ny * ny + nz * nz))
       ELSE least({_arc("latitude", "longitude", "alat", "alon")}, {_arc("latitude", "longitude", "blat", "blon")}) END AS km
FROM (SELECT *, {_named("p", "latitude", "longitude")} FROM positions) JOIN legs USING (delivery_id)"""
_VIEWS["positions"] = """
SELECT row_number() OVER () AS event_row, event_id, delivery_id, vehicle_id, event_timestamp, latitude, longitude FROM delivery_events"""
_VIEWS["nearest_legs"] = "SELECT event_row, min(km) AS deviation_km FROM leg_distances GROUP BY 1"


def _failed(table: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER ({condition}) AS failed_count FROM {table}"
        for rule, condition in conditions.items()
    )


PARTS = "fuel_cost + driver_cost + toll_cost + maintenance_cost + other_cost"
DOUBLE_PARTS = " + ".join(dbl(p) for p in PARTS.split(" + "))
NOT_NULL = "cost_id business_date delivery_id route_id vehicle_id warehouse_id region".split()
NON_NEGATIVE = [
    *(c for c in COST_DECIMALS if c != "vehicle_capacity"),
    "delivery_count", "planned_duration_minutes", "actual_duration_minutes",
]

# Failing condition of every telemetry contract rule.
TELEMETRY_RULES = {
    "schema_version:const": "schema_version <> 1",
    "event_id:min_length": "length(event_id) < 1",
    "event_type:const": "event_type <> 'VEHICLE_TELEMETRY'",
    "vehicle_id:pattern": "NOT regexp_full_match(vehicle_id, 'VEH-[0-9]{3}')",
    "driver_id:pattern": "NOT regexp_full_match(driver_id, 'DRV-[0-9]{3}')",
    "latitude:minimum": "latitude < -90",
    "latitude:maximum": "latitude > 90",
    "longitude:minimum": "longitude < -180",
    "longitude:maximum": "longitude > 180",
    "speed_kmh:minimum": "speed_kmh < 0",
    "speed_kmh:maximum": "speed_kmh > 180",
    "fuel_level_pct:minimum": "fuel_level_pct < 0",
    "fuel_level_pct:maximum": "fuel_level_pct > 100",
    "engine_temperature_c:minimum": "engine_temperature_c < -40",
    "engine_temperature_c:maximum": "engine_temperature_c > 160",
    "odometer_km:minimum": "odometer_km < 0",
    "engine_status:enum": "engine_status NOT IN ('RUNNING', 'IDLE', 'OFF')",
    "vehicle_status:enum": "vehicle_status NOT IN ('IN_TRANSIT', 'IDLE', 'MAINTENANCE', 'OFFLINE')",
}


def _contract(table: str, rules: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{reason}' END" for reason, condition in rules.items())
    return f"""
SELECT valid, reason, count(*) AS row_count FROM (
  SELECT CASE WHEN len(reasons) = 0 THEN 1 ELSE 0 END AS valid,
         unnest(CASE WHEN len(reasons) = 0 THEN [''] ELSE reasons END) AS reason
  FROM (SELECT [r FOR r IN [{cases}] IF r IS NOT NULL] AS reasons FROM {table}))
GROUP BY ALL"""


def _chart(view: str, metrics: dict[str, str], keys: str = "", limit: int | None = None) -> str:
    """A limited chart orders by its first metric and its keys; a big number has no keys."""
    columns = ", ".join(f"{sql} AS {name}" for name, sql in metrics.items())
    if not keys:
        return f"SELECT {columns} FROM {view}"
    cut = f" ORDER BY {next(iter(metrics))} DESC, {keys} LIMIT {limit}" if limit else ""
    return f"SELECT {keys}, {columns} FROM {view} GROUP BY {keys}{cut}"


def _money(*names: str) -> dict[str, str]:
    return {n: dbl(f"sum({n})") for n in names}


LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ROUTE_COST = {**_money("actual_cost"), "cost_per_delivery": "sum(cost_per_delivery)", "cost_variance": "sum(cost_variance)"}


def _pivot() -> str:
    cells = []
    for level in LEVELS:
        for metric in ("delay_rate", "avg_delay_minutes"):
            value = f"CASE WHEN service_level = '{level}' THEN {metric} END"
            cells.append(f'avg({value}) AS "{level}_{metric}"')
    return f"SELECT region, {', '.join(cells)} FROM delay_by_region GROUP BY region"


def _dashboard(view: str) -> str:
    """The cost charts one by one, under their names; a chart lacks the columns of the others."""
    breakdown = _money("fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost")
    risk = {**_money("actual_cost"), **{c: f"avg({c})" for c in ("delay_rate", "avg_delay_minutes")}, "cost_delay_risk_score": "sum(cost_delay_risk_score)"}
    charts = {
        "actual_cost": _chart(view, _money("actual_cost")),
        "cost_variance": _chart(view, {"cost_variance": "sum(cost_variance)"}),
        "cost_per_delivery": _chart(view, {"cost_per_delivery": "sum(cost_per_delivery)"}),
        "cost_breakdown": _chart(view, breakdown, "business_date"),
        "route_cost": _chart(view, ROUTE_COST, "route_id, region"),
        "warehouse_cost": _chart(view, _money("actual_cost"), "warehouse_id, region"),
        "route_risk": _chart(view, risk, "route_id, warehouse_id, region"),
    }
    return " UNION ALL BY NAME ".join(f"SELECT '{name}' AS chart, * FROM ({sql})" for name, sql in charts.items())


def _trend(grain: str) -> str:
    return f"""
SELECT *, delayed_deliveries / greatest(1, completed_deliveries + delayed_deliveries) AS delay_rate
FROM (SELECT CAST(date_trunc('{grain}', event_timestamp) AS DATE) AS period, count(*) AS event_count,
             {isum("is_completed")} AS completed_deliveries, {isum("is_delayed")} AS delayed_deliveries,
             {iavg("delay_minutes")} AS avg_delay_minutes, {dbl("sum(order_value)")} AS total_order_value
      FROM enriched GROUP BY ALL)"""


def _performance(keys: str) -> str:
    return f"""
SELECT business_date, {keys}, count(*) AS event_count, {isum("is_completed")} AS completed_deliveries,
       {isum("is_delayed")} AS delayed_deliveries, {iavg("delay_minutes")} AS avg_delay_minutes,
       {DELAY_RATE} AS delay_rate, avg(planned_distance_km) AS avg_distance_km,
       {dbl("sum(order_value)")} AS total_order_value
FROM enriched GROUP BY ALL"""


def _orphans(column: str, parent: str) -> str:
    return f"""SELECT '{column}' AS relationship, count(*) AS orphan_count FROM transportation_costs c
WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"""


COVER = "delivery_id, route_id, vehicle_id, warehouse_id, region"
STEPS = "['ORDER_LOADED', 'VEHICLE_DEPARTED', 'IN_TRANSIT', 'DELIVERY_DELAYED', 'DELIVERED']"
CHORD = (
    "pow(sin(radians(s.latitude - w.lat) / 2), 2) + cos(radians(w.lat)) * cos(radians(s.latitude)) "
    "* pow(sin(radians(s.longitude - w.lon) / 2), 2)"
)
_VIEWS["signals"] = f"""
SELECT delivery_id, vehicle_id, route_id, status, arrival_delay_minutes, depot_km,
       greatest(planned_distance_km - depot_km, 0e0) / 40e0 * 60 AS eta_minutes,
       CASE WHEN arrival_delay_minutes >= 15 THEN 1 ELSE 0 END AS is_late,
       CASE WHEN depot_km > planned_distance_km + 5e0 THEN 1 ELSE 0 END AS is_off_route
FROM (SELECT s.*, date_diff('second', planned_arrival_timestamp, estimated_arrival_timestamp) / 60 AS arrival_delay_minutes,
             round(12742e0 * asin(sqrt(least({CHORD}, 1e0))), 3) AS depot_km
      FROM delivery_state s
      LEFT JOIN (SELECT warehouse_id, {dbl("latitude")} AS lat, {dbl("longitude")} AS lon FROM warehouses) w USING (warehouse_id)
      WHERE status <> 'DELIVERED')"""


def _upsert() -> str:
    """A key with a heavy load takes the revised measures of its latest one; that load adds a return trip."""
    revised = {
        "other_cost": "h.other_cost + 5",
        "actual_total_cost": "h.actual_total_cost + 5",
        "updated_at": "h.updated_at + INTERVAL '1' DAY",
    }
    changed = ", ".join(
        f"CASE WHEN h.cost_id IS NOT NULL THEN {revised.get(c, f'h.{c}')} ELSE b.{c} END AS {c}" for c in COST_UPDATE_COLUMNS
    )
    return f"""
SELECT * {AS_COST} FROM (
  SELECT b.* REPLACE ({changed}) FROM current_costs b LEFT JOIN heavy_costs h ON b.cost_id = h.cost_id
  UNION ALL
  SELECT * REPLACE (concat('return-', cost_id) AS cost_id) FROM heavy_costs)"""


def _seconds(start: str, end: str) -> str:
    return f"date_diff('second', {start}, {end})"


def statements() -> dict[str, str]:
    window_closed = "window_end <= (SELECT max(date_trunc('millisecond', event_timestamp)) - INTERVAL '10 seconds' FROM admitted)"
    history = [c for c in EVENT_COLUMNS if c != "order_value"]
    bodies = {
        "daily_delivery_kpi": f"SELECT * {AS_MONEY} FROM kpi",
        "daily_delivery_kpi_dedup": f"SELECT * {AS_MONEY} FROM ({_kpi('unique_events')})",
        "bronze_events": f"SELECT {', '.join(history)}, business_date, {dbl('order_value')} AS order_value FROM unique_events",
        "delivery_current_state": f"SELECT * {AS_ORDER} FROM delivery_state",
        "vehicle_current_state": "SELECT * FROM vehicle_state",
        "status_overview": "SELECT * FROM status_overview",
        "delay_by_region": "SELECT * FROM delay_by_region",
        "vehicle_utilization": "SELECT * FROM vehicle_utilization",
        "warehouse_daily_kpi": f"SELECT * {AS_MONEY} FROM warehouse_daily_kpi",
        "event_volume": "SELECT * FROM event_volume",
        "route_delay": "SELECT * FROM route_delay",
        "cost_silver": f"""SELECT * {AS_COST}, 'run' AS _pipeline_run_id,
            'driver-tables' AS _source_system, business_date AS _batch_date FROM cost_silver""",
        "cost_gold": f"SELECT * {AS_GOLD} FROM cost_gold",
        "cost_gold_for_date": f"""SELECT * {AS_GOLD} FROM ({_gold("business_date = DATE '1998-09-02'")})""",
        "cost_gold_table": f"""SELECT * {AS_GOLD} FROM (
            SELECT * FROM corrected_gold UNION ALL
            SELECT * FROM cost_gold g WHERE NOT EXISTS (SELECT 1 FROM corrected_gold c WHERE c.business_date = g.business_date
                AND c.warehouse_id = g.warehouse_id AND c.region = g.region AND c.route_id = g.route_id))""",
        "cost_performance": f"SELECT * {AS_GOLD} FROM cost_performance",
        "quality_cost": _failed(
            "transportation_costs",
            {
                "not_null": " OR ".join(f"{c} IS NULL" for c in NOT_NULL),
                "non_negative": " OR ".join(f"{c} < 0" for c in NON_NEGATIVE),
                "equality:actual_total_cost": f"abs({ACTUAL} - ({DOUBLE_PARTS})) > 0.01e0",
            },
        ),
        "quality_telemetry": _failed(
            "vehicle_telemetry",
            {
                "not_null": "event_id IS NULL OR event_timestamp IS NULL OR vehicle_id IS NULL",
                "accepted_values:engine_status": "engine_status NOT IN ('RUNNING', 'IDLE', 'OFF')",
            },
        ),
        "source_checks": " UNION ALL ".join(
            [
                _failed(
                    "transportation_costs",
                    {
                        "used_within_capacity": "used_capacity > vehicle_capacity",
                        "total_is_sum_of_parts": f"actual_total_cost <> {PARTS}",
                        "capacity_positive": "vehicle_capacity <= 0",
                        **{f"{c}_not_negative": f"{c} < 0" for c in NON_NEGATIVE},
                    },
                ),
                _failed(
                    "customer_orders",
                    {
                        "order_value_not_negative": "order_value < 0",
                        "package_count_positive": "package_count <= 0",
                        "promised_after_created": "promised_delivery_at <= order_created_at",
                    },
                ),
                _failed(
                    "delivery_plans",
                    {
                        "arrival_after_departure": "planned_arrival_at <= planned_departure_at",
                        "distance_not_negative": "planned_distance_km < 0",
                    },
                ),
                _failed("vehicles", {"capacity_total_positive": "capacity_total <= 0"}),
            ]
        ),
        "event_checks": _failed(
            "delivery_events",
            {
                "missing_id": "coalesce(trim(event_id), '') = '' OR coalesce(trim(delivery_id), '') = '' OR coalesce(trim(vehicle_id), '') = ''",
                "missing_timestamp": "event_timestamp IS NULL",
                "invalid_position": "abs(latitude) > 90 OR abs(longitude) > 180",
                "unknown_status": f"NOT coalesce(list_contains({STEPS}, status), FALSE)",
                "negative_value": "order_value < 0",
                "impossible_capacity": "capacity_used < 0 OR capacity_total <= 0 OR capacity_used > capacity_total",
                "estimate_far_behind_plan": "estimated_arrival_timestamp > planned_arrival_timestamp + INTERVAL '1' DAY",
            },
        ),
        "relationships_cost": " UNION ALL ".join(
            [_orphans("delivery_id", "delivery_plans"), _orphans("vehicle_id", "vehicles"), _orphans("warehouse_id", "warehouses")]
        ),
        "event_cost_coverage": f"""
            SELECT count(*) AS key_count, count(seen) AS covered_key_count, {isum("n")} AS row_count,
                   coalesce({isum("CASE WHEN seen = 1 THEN n END")}, 0) AS covered_row_count
            FROM (SELECT {COVER}, count(*) AS n FROM delivery_events GROUP BY ALL)
            LEFT JOIN (SELECT DISTINCT {COVER}, 1 AS seen FROM transportation_costs) USING ({COVER})""",
        "duplicate_keys": "SELECT event_id, count(*) AS n FROM delivery_events GROUP BY 1 HAVING count(*) > 1",
        "duplicate_cost_keys": "SELECT cost_id, count(*) AS n FROM transportation_costs GROUP BY 1 HAVING count(*) > 1",
        "duplicate_plates": """
            SELECT 'vehicle_id' AS key_column, vehicle_id AS key_value, count(*) AS n FROM vehicles GROUP BY 2 HAVING count(*) > 1
            UNION ALL
            SELECT 'plate_number', plate_number, count(*) FROM vehicles GROUP BY 2 HAVING count(*) > 1""",
        "duplicate_confirmations": """SELECT delivery_id, count(*) AS n FROM delivery_events WHERE status = 'DELIVERED'
            GROUP BY 1 HAVING count(*) > 1""",
        "events_before_shipment": """
            SELECT event_id, shipment_id, event_timestamp, status, created_at AS shipment_created_at
            FROM delivery_events JOIN shipments USING (shipment_id) WHERE event_timestamp < created_at""",
        "arrivals_before_departure": """
            SELECT * FROM (SELECT delivery_id, min(event_timestamp) FILTER (status = 'VEHICLE_DEPARTED') AS departed_at,
                                  min(event_timestamp) FILTER (status = 'DELIVERED') AS delivered_at
                           FROM delivery_events GROUP BY 1) WHERE delivered_at < departed_at""",
        "status_transitions": f"""
            SELECT previous_status, status, count(*) AS transition_count,
                   CASE WHEN list_contains({STEPS}, status) AND (previous_status = '' OR
                        list_position({STEPS}, previous_status) <= list_position({STEPS}, status)) THEN 1 ELSE 0 END AS is_allowed
            FROM (SELECT status, coalesce(lag(status) OVER (PARTITION BY delivery_id
                         ORDER BY event_timestamp, event_id, vehicle_id, route_id), '') AS previous_status FROM delivery_events)
            GROUP BY previous_status, status""",
        "contract_split": _contract("vehicle_telemetry", TELEMETRY_RULES),
        "contract_split_json": _contract(
            "delivery_events", {"payload.capacity_total:exclusive_minimum": "capacity_total <= 0"}
        ),
        "json_parse_events": f"SELECT * {AS_ORDER}, FALSE AS is_corrupt FROM delivery_events",
        "telemetry_raw": "SELECT * FROM admitted",
        "fleet_current_state": "SELECT * FROM fleet_state",
        "health_alerts": "SELECT * FROM alerts",
        "health_alerts_sql": "SELECT * FROM alerts",
        "vehicle_extremes_sql": """
            SELECT vehicle_id, count(*) AS reading_count, max(speed_kmh) AS max_speed_kmh,
                   min(fuel_level_pct) AS min_fuel_level_pct, max(engine_temperature_c) AS max_engine_temperature_c,
                   count(*) FILTER (speed_kmh >= 100) AS overspeed_count FROM admitted GROUP BY 1""",
        "fleet_metrics_5m": "SELECT * FROM fleet_metrics",
        "fleet_metrics_5m_stream": f"SELECT * FROM fleet_metrics WHERE {window_closed}",
        "health_alerts_stream": "SELECT * FROM alerts",
        "telemetry_raw_stream": "SELECT * FROM admitted",
        "telemetry_dedup_stream": "SELECT DISTINCT * FROM admitted",
        "fleet_state_stream": "SELECT * FROM fleet_state",
        "delivery_state_stream": f"SELECT * {AS_ORDER} FROM delivery_state",
        "vehicle_state_stream": "SELECT * FROM vehicle_state",
        "delivery_history_stream": f"SELECT * {AS_MONEY} FROM kpi",
        "bi_status_overview": _chart("status_overview", {"event_count": isum("event_count")}, "status"),
        "bi_delay_pivot": _pivot(),
        "bi_vehicle_utilization": _chart(
            "vehicle_utilization",
            {"avg_utilization_ratio": "avg(avg_utilization_ratio)"},
            "vehicle_id, active_status, route_id",
        ),
        "bi_warehouse_kpi": _chart(
            "warehouse_daily_kpi",
            {
                **{c: isum(c) for c in ("completed_deliveries", "delayed_deliveries", "on_time_deliveries")},
                "delay_rate": "avg(delay_rate)",
                "on_time_rate": "avg(on_time_rate)",
                **_money("total_order_value"),
            },
            "business_date, region, warehouse_id",
        ),
        "bi_hourly_volume": _chart("event_volume", {"event_count": isum("event_count")}, "event_hour, event_type"),
        "bi_actual_cost": _chart("cost_performance", _money("actual_cost")),
        "bi_cost_variance": _chart("cost_performance", {"cost_variance": "sum(cost_variance)"}),
        "bi_cost_per_delivery": _chart("cost_performance", {"cost_per_delivery": "sum(cost_per_delivery)"}),
        "bi_cost_per_delivery_avg": _chart("cost_performance", {"cost_per_delivery": "avg(cost_per_delivery)"}),
        "bi_cost_breakdown": _chart(
            "cost_performance",
            _money("fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost"),
            "business_date",
        ),
        "bi_route_cost": _chart("cost_performance", ROUTE_COST, "route_id, region"),
        "bi_route_cost_limited": _chart("cost_performance", ROUTE_COST, "route_id, region", limit=ROW_LIMIT),
        "bi_warehouse_cost": _chart("cost_performance", _money("actual_cost"), "warehouse_id, region"),
        "bi_route_risk": _chart(
            "cost_performance",
            {
                **_money("actual_cost"),
                "delay_rate": "avg(delay_rate)",
                "avg_delay_minutes": "avg(avg_delay_minutes)",
                "cost_delay_risk_score": "sum(cost_delay_risk_score)",
            },
            "route_id, warehouse_id, region",
        ),
        "bi_filtered_cost": _chart(
            """(SELECT * FROM cost_performance WHERE business_date >= DATE '1997-01-01'
                AND business_date < DATE '1998-01-01' AND region IN ('ASIA', 'EUROPE'))""",
            ROUTE_COST,
            "route_id, region",
        ),
        "bi_cost_dashboard": _dashboard("cost_performance"),
        "bi_cost_dashboard_filtered": _dashboard(
            """(SELECT * FROM cost_performance WHERE business_date >= DATE '1996-01-01' AND business_date < DATE '2006-01-01'
                AND region IN ('EUROPE', 'MIDDLE EAST')
                AND warehouse_id IN ('warehouse-3', 'warehouse-6', 'warehouse-9', 'warehouse-13', 'warehouse-19')
                AND route_id IN ('route-EUROPE-0', 'route-EUROPE-1', 'route-MIDDLE EAST-0', 'route-MIDDLE EAST-5'))"""
        ),
        "upsert_cost": _upsert(),
        "insert_absent": """
            SELECT delivery_id, shipment_id, vehicle_id, driver_id, route_id, event_timestamp FROM delivery_events
            WHERE delivery_id NOT IN (SELECT delivery_id FROM delivery_plans)
            QUALIFY row_number() OVER (PARTITION BY delivery_id
                                       ORDER BY event_timestamp DESC, vehicle_id DESC, route_id DESC) = 1""",
        "retention_events": """SELECT event_id, event_timestamp, delivery_id, vehicle_id, route_id FROM delivery_events
            WHERE event_timestamp + INTERVAL '30' DAY > TIMESTAMP '2001-11-01'""",
        "history_layout": """SELECT CAST(strftime(event_timestamp, '%Y%m') AS INT) AS event_month, count(*) AS row_count,
            count(DISTINCT event_id) AS event_count FROM delivery_events GROUP BY 1""",
        "freshness": """
            SELECT *, CASE WHEN lag_seconds <= 300 THEN 1 ELSE 0 END AS is_fresh
            FROM (SELECT count(*) AS row_count, max(event_timestamp) AS newest,
                         epoch_ms(TIMESTAMP '2024-01-31') // 1000 - epoch_ms(max(event_timestamp)) // 1000 AS lag_seconds
                  FROM vehicle_telemetry)""",
        "source_readiness": "SELECT count(*) AS row_count FROM transportation_costs WHERE business_date = DATE '1998-09-02'",
        "incremental_cost": f"SELECT * {AS_COST} FROM transportation_costs WHERE updated_at >= TIMESTAMP '2000-06-01' OR updated_at IS NULL",
        "source_sample": f"""SELECT order_id, service_level, {dbl("order_value")} AS order_value FROM customer_orders
            ORDER BY order_id LIMIT 10""",
        "source_trace": """SELECT order_id, shipment_id, delivery_id, driver_id FROM customer_orders
            JOIN shipments USING (order_id) JOIN delivery_plans USING (shipment_id)""",
        "planned_vs_actual": f"""
            SELECT delivery_id, shipment_id, driver_id, {dbl("planned_distance_km")} AS planned_distance_km,
                   planned_departure_at, planned_arrival_at, actual_departure_at, actual_arrival_at,
                   {_seconds("planned_departure_at", "actual_departure_at")} AS departure_delay_seconds,
                   {_seconds("planned_arrival_at", "actual_arrival_at")} AS arrival_delay_seconds,
                   {_seconds("planned_departure_at", "planned_arrival_at")} AS planned_duration_seconds,
                   {_seconds("actual_departure_at", "actual_arrival_at")} AS actual_duration_seconds
            FROM delivery_plans LEFT JOIN (
              SELECT delivery_id, min(event_timestamp) FILTER (status = 'VEHICLE_DEPARTED') AS actual_departure_at,
                     min(event_timestamp) FILTER (status = 'DELIVERED') AS actual_arrival_at
              FROM delivery_events GROUP BY 1) USING (delivery_id)""",
        "trends_all": " UNION ALL ".join(f"SELECT '{g}' AS grain, * FROM ({_trend(g)})" for g in ("day", "week", "month")),
        "trend_day": _trend("day"),
        "trend_week": _trend("week"),
        "trend_month": _trend("month"),
        "cost_trend_month": f"""
            SELECT period, {dbl("actual_cost")} AS actual_cost, {dbl("planned_cost")} AS planned_cost, total_deliveries,
                   {dbl("actual_cost - planned_cost")} AS cost_variance,
                   {ratio(dbl("actual_cost"), dbl("total_deliveries"))} AS cost_per_delivery
            FROM (SELECT CAST(date_trunc('month', business_date) AS DATE) AS period, sum(actual_cost) AS actual_cost,
                         sum(planned_cost) AS planned_cost, {isum("total_deliveries")} AS total_deliveries
                  FROM cost_gold GROUP BY 1)""",
        "vehicle_utilization_daily": f"""
            SELECT business_date, vehicle_id, count(*) AS event_count, count(DISTINCT delivery_id) AS delivery_count,
                   avg(utilization_ratio) AS avg_utilization_ratio, max(utilization_ratio) AS max_utilization_ratio
            FROM enriched GROUP BY ALL""",
        "route_performance_daily": _performance("route_id"),
        "warehouse_performance_daily": _performance("warehouse_id, region"),
        "delivery_delay_analysis": f"""
            SELECT region, traffic_condition, weather_condition, count(*) AS event_count,
                   {isum("is_delayed")} AS delayed_event_count, {iavg("delay_minutes")} AS avg_delay_minutes,
                   max(delay_minutes) AS max_delay_minutes, {DELAY_RATE} AS delay_rate
            FROM enriched GROUP BY ALL""",
        "delivery_durations": f"""
            SELECT region, count(*) AS delivery_count, sum(distance_km) AS total_distance_km,
                   {iavg("duration_seconds")} AS avg_duration_seconds
            FROM (SELECT delivery_id, min(region) AS region, max(planned_distance_km) AS distance_km,
                         {_seconds("min(event_timestamp)", "max(event_timestamp)")} AS duration_seconds
                  FROM delivery_events GROUP BY 1) GROUP BY 1""",
        "top_delayed_routes": f"""SELECT route_id, {isum("delay_minutes")} AS total_delay_minutes FROM delivery_events
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "top_cost_routes": f"""SELECT route_id, {dbl("sum(actual_total_cost)")} AS actual_cost FROM transportation_costs
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "active_deliveries": f"""SELECT region, status, count(*) AS delivery_count, {isum("package_count")} AS package_count
            FROM delivery_state WHERE status <> 'DELIVERED' GROUP BY ALL""",
        "active_vehicle_workload": f"""
            SELECT vehicle_id, vehicle_type, coalesce(open_deliveries, 0) AS open_deliveries,
                   coalesce(open_packages, 0) AS open_packages
            FROM vehicles LEFT JOIN (SELECT vehicle_id, count(*) AS open_deliveries, {isum("package_count")} AS open_packages
                                     FROM delivery_state WHERE status <> 'DELIVERED' GROUP BY 1) USING (vehicle_id)
            WHERE active""",
        "delay_signals": "SELECT * FROM signals",
        "problem_shipments": "SELECT * FROM signals WHERE is_late = 1 OR is_off_route = 1",
        "fleet_metrics_corrected_stream": f"SELECT * FROM fleet_metrics WHERE {window_closed}",
        "late_telemetry_stream": """
            SELECT a.* EXCLUDE (part), watermark, (epoch_us(watermark) // 1000 - epoch_us(event_timestamp) // 1000) / 1000 AS lag_seconds
            FROM arrived a JOIN marks USING (part)
            WHERE time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' <= watermark""",
        "delivery_state_keyed_stream": f"SELECT * {AS_ORDER} FROM delivery_state",
        "telemetry_dedup_history_stream": "SELECT DISTINCT * FROM admitted",
        "active_vehicles_by_period": " UNION ALL ".join(
            f"""SELECT '{grain}' AS grain, CAST(date_trunc('{grain}', event_timestamp) AS TIMESTAMP) AS period, vehicle_status,
                count(DISTINCT vehicle_id) AS active_vehicle_count FROM admitted GROUP BY ALL"""
            for grain in ("day", "week", "month")
        ),
        "telemetry_history_kept": """
            SELECT * EXCLUDE (first_day) REPLACE (CAST(first_day + to_months(CAST(CAST(event_id AS BIGINT) % 4 AS INT)) AS TIMESTAMP) AS event_timestamp),
                   strftime(first_day + to_months(CAST(CAST(event_id AS BIGINT) % 4 AS INT)), '%Y%m') AS event_month
            FROM (SELECT *, CAST(min(event_timestamp) OVER () AS DATE) AS first_day FROM admitted)
            WHERE CAST(event_id AS BIGINT) % 4 > 0""",
        "cost_change_feed": f"""
            SELECT * {AS_COST} FROM (
              SELECT 'delete' AS change, * EXCLUDE (kind) FROM old_costs WHERE kind = 0
              UNION ALL SELECT 'update_before', * EXCLUDE (kind) FROM old_costs WHERE {_FIXED}
              UNION ALL SELECT 'update_after', n.* FROM new_costs n SEMI JOIN (SELECT cost_id FROM old_costs WHERE {_FIXED}) USING (cost_id)
              UNION ALL SELECT 'insert', n.* FROM new_costs n WHERE cost_id LIKE 'extra-%')""",
        "cost_feed_applied": f"SELECT * {AS_COST} FROM new_costs",
        "cost_gold_incremental": f"SELECT * {AS_GOLD} FROM ({_gold(source='new_silver')})",
        "late_telemetry_by_hour": """
            SELECT date_trunc('hour', event_timestamp) AS event_hour, count(*) AS row_count, count(*) FILTER (lag_seconds > 30) AS late_count,
                   max(lag_seconds) AS worst_lag_seconds
            FROM (SELECT event_timestamp, greatest(0e0, coalesce((epoch_us(max(event_timestamp) OVER (
                         ORDER BY taken_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - epoch_us(event_timestamp)) / 1e6, 0e0)) AS lag_seconds
                  FROM (SELECT event_timestamp, CAST(event_id AS BIGINT) AS id, ingestion_timestamp
                               + CASE WHEN CAST(event_id AS BIGINT) % 97 = 0 THEN 600 WHEN CAST(event_id AS BIGINT) % 13 = 0 THEN 45 ELSE 0 END
                               * INTERVAL '1' SECOND AS taken_at FROM vehicle_telemetry))
            GROUP BY 1""",
        "route_deviation": """
            SELECT * EXCLUDE (event_row), CASE WHEN deviation_km > 2 THEN 1 ELSE 0 END AS is_off_route
            FROM positions LEFT JOIN nearest_legs USING (event_row)""",
    }
    return {name: _rounded(name, f"WITH {_needed(body)}\n{body}") for name, body in bodies.items()}


def _rounded(name: str, sql: str) -> str:
    digits = ", ".join(f"round({c}, {n}) AS {c}" for c, n in DIGITS.get(name, {}).items())
    return f"SELECT * REPLACE ({digits}) FROM ({sql})" if digits else sql


def _needed(body: str) -> str:
    """The views a statement rests on, each after the ones it names itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name, sql in _VIEWS.items():
            if name in words and name not in order:
                visit(sql)
                order.append(name)

    visit(body)
    return ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in order)
