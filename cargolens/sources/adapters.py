"""The logistics tables as views over the TPC-H-like driver tables.

Each view is plain SQL that Spark and DuckDB both accept, so the checks can state
the same input. ``delivery_events`` is split into the columns that come from the
line item side and the ones that need ``orders``. Those come through a left join on the unique
key of ``orders``, which neither drops nor repeats a row, so a reader that wants none of
them is spared the largest join of all and still sees the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.session import free_shuffles, shared_dir

_EVENT_TIME = "l_shipdate + l_linenumber * INTERVAL '1' HOUR"
_DELAY = "CAST(greatest(0e0, l_quantity - 30e0) AS INT)"

EVENT_LINE_COLUMNS = {
    "schema_version": "1",
    "event_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "status": """CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'ORDER_LOADED'
            WHEN l_returnflag = 'N' THEN 'VEHICLE_DEPARTED'
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'IN_TRANSIT'
            WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'DELIVERY_DELAYED'
            ELSE 'DELIVERED' END""",
    "event_timestamp": _EVENT_TIME,
    "delivery_id": "concat('delivery-', CAST(l_orderkey AS STRING))",
    "shipment_id": "concat('shipment-', CAST(l_orderkey AS STRING))",
    "order_id": "concat('order-', CAST(l_orderkey AS STRING))",
    "vehicle_id": "concat('vehicle-', CAST(l_suppkey AS STRING))",
    "driver_id": "concat('driver-', CAST(l_suppkey % 10 AS STRING))",
    "route_id": "concat('route-', r_name, '-', CAST(l_partkey % 6 AS STRING))",
    "warehouse_id": "concat('warehouse-', CAST(s_nationkey AS STRING))",
    "region": "r_name",
    "priority": "CASE l_orderkey % 3 WHEN 0 THEN 'normal' WHEN 1 THEN 'high' ELSE 'critical' END",
    "destination_city": "n_name",
    "latitude": "CAST(40 + (l_partkey % 100) * 0.001 AS DOUBLE)",
    "longitude": "CAST(49 + (l_partkey % 100) * 0.001 AS DOUBLE)",
    "delay_minutes": _DELAY,
    "planned_arrival_timestamp": f"{_EVENT_TIME} + 35 * INTERVAL '1' MINUTE",
    "estimated_arrival_timestamp": f"{_EVENT_TIME} + CAST(35e0 + greatest(0e0, l_quantity - 30e0) AS INT) * INTERVAL '1' MINUTE",
    "capacity_used": "l_quantity",
    "capacity_total": "CASE l_suppkey % 4 WHEN 0 THEN 0e0 WHEN 1 THEN 80e0 WHEN 2 THEN 120e0 ELSE 160e0 END",
    "package_count": "CAST(l_quantity AS INT)",
    "order_value": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "payment_method": "CASE l_orderkey % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'cash' ELSE 'corporate_account' END",
    "planned_distance_km": "CAST(8.5 + (l_orderkey % 24) * 2.25 AS DOUBLE)",
    "traffic_condition": "CASE l_partkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'heavy' END",
    "weather_condition": "CASE l_partkey % 3 WHEN 0 THEN 'clear' WHEN 1 THEN 'windy' ELSE 'rain' END",
}
EVENT_LINE_COLUMNS["event_type"] = EVENT_LINE_COLUMNS["status"]
EVENT_ORDER_COLUMNS = {
    "service_level": "o_orderpriority",
    "customer_id": "concat('customer-', CAST(o_custkey AS STRING))",
}
_PLACES = "JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"


def events_sql(columns: Iterable[str] | None = None) -> tuple[str, list[str]]:
    """SQL text with ``{table}`` slots, and the tables it names."""
    known = EVENT_LINE_COLUMNS | EVENT_ORDER_COLUMNS
    wanted = list(columns) if columns is not None else list(known)
    select = ",\n       ".join(f"{known[name]} AS {name}" for name in wanted)
    tables = ["lineitem", "supplier", "nation", "region"]
    join = ""
    if set(wanted) & set(EVENT_ORDER_COLUMNS):
        join = "LEFT JOIN {orders} ON l_orderkey = o_orderkey "
        tables.append("orders")
    return f"SELECT {select}\nFROM {{lineitem}} {join}{_PLACES}", tables


COSTS_SQL = f"""
SELECT concat('cost-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS cost_id,
       CAST(l_shipdate + CASE WHEN l_orderkey % 200 = 0 THEN 4000 ELSE 0 END * INTERVAL '1' DAY AS DATE) AS business_date,
       concat('delivery-', CAST(l_orderkey AS STRING)) AS delivery_id,
       concat('route-', r_name, '-', CAST(l_partkey % 6 AS STRING)) AS route_id,
       concat('vehicle-', CAST(l_suppkey AS STRING)) AS vehicle_id,
       concat('warehouse-', CAST(s_nationkey AS STRING)) AS warehouse_id,
       r_name AS region,
       CAST(20 + (l_partkey % 6) * 7.5 AS DECIMAL(12,2)) AS planned_distance_km,
       CAST((l_partkey % 7) * 9.25 AS DECIMAL(12,2)) AS actual_distance_km,
       CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE 100 + l_quantity * 2 END AS DECIMAL(12,2)) AS planned_cost,
       CAST(l_quantity * 1.25 AS DECIMAL(12,2)) AS fuel_cost,
       CAST(60 + (l_orderkey % 50) AS DECIMAL(12,2)) AS driver_cost,
       CAST((l_suppkey % 3) * 4 AS DECIMAL(12,2)) AS toll_cost,
       CAST((l_partkey % 9) * 0.5 AS DECIMAL(12,2)) AS maintenance_cost,
       CAST(l_linenumber * 3.5 AS DECIMAL(12,2)) AS other_cost,
       CAST(l_quantity * 1.25 + 60 + (l_orderkey % 50) + (l_suppkey % 3) * 4 + (l_partkey % 9) * 0.5 + l_linenumber * 3.5
            + CASE WHEN l_orderkey % 1000 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS actual_total_cost,
       CAST(l_quantity * 0.8 AS DECIMAL(12,2)) AS fuel_liters,
       CAST(l_quantity AS INT) AS delivery_count,
       CAST(160 AS DECIMAL(12,2)) AS vehicle_capacity,
       CAST(l_quantity AS DECIMAL(12,2)) AS used_capacity,
       CAST(90 + l_linenumber * 8 AS INT) AS planned_duration_minutes,
       CAST(90 + (l_partkey % 40) AS INT) AS actual_duration_minutes,
       CAST(l_shipdate AS TIMESTAMP) AS created_at,
       CAST(l_shipdate + INTERVAL '1' DAY AS TIMESTAMP) AS updated_at
FROM {{lineitem}} {_PLACES}"""

TELEMETRY_SQL = """
SELECT CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END AS schema_version,
       CAST(event_id AS STRING) AS event_id,
       CASE WHEN event_type = 'error' THEN 'HEARTBEAT' ELSE 'VEHICLE_TELEMETRY' END AS event_type,
       ts AS event_timestamp,
       ts + INTERVAL '1' SECOND AS ingestion_timestamp,
       concat('VEH-', lpad(CAST(user_id % 1000 AS STRING), 3, '0')) AS vehicle_id,
       concat('DRV-', lpad(CAST(user_id % 20 AS STRING), 3, '0')) AS driver_id,
       CAST(40 + (event_id % 100) * 0.001 AS DOUBLE) AS latitude,
       CAST(49 + (event_id % 100) * 0.001 AS DOUBLE) AS longitude,
       least(180e0, value) AS speed_kmh,
       CAST((event_id * 7) % 100 AS DOUBLE) AS fuel_level_pct,
       CAST(80 + (event_id * 13) % 40 AS DOUBLE) AS engine_temperature_c,
       CAST(145000 + event_id AS DOUBLE) AS odometer_km,
       CASE WHEN event_id % 6 = 5 THEN 'IDLE' ELSE 'RUNNING' END AS engine_status,
       CASE WHEN event_id % 6 = 5 THEN 'IDLE' ELSE 'IN_TRANSIT' END AS vehicle_status
FROM {events}"""

WAREHOUSES_SQL = """
SELECT concat('warehouse-', CAST(n_nationkey AS STRING)) AS warehouse_id,
       concat(n_name, ' hub') AS warehouse_name, r_name AS region, n_name AS city,
       CAST(40 + n_nationkey * 0.01 AS DECIMAL(9,6)) AS latitude,
       CAST(49 + n_nationkey * 0.01 AS DECIMAL(9,6)) AS longitude
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

# Some vehicles share a plate or have no capacity, some orders no package, and some costs a day without
# deliveries: each check over these tables has something to find.
VEHICLES_SQL = """
SELECT concat('vehicle-', CAST(s_suppkey AS STRING)) AS vehicle_id,
       concat('plate-', CAST(s_suppkey - CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS STRING)) AS plate_number,
       CASE s_suppkey % 2 WHEN 0 THEN 'truck' ELSE 'van' END AS vehicle_type,
       CAST(CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE 160 END AS DECIMAL(12,2)) AS capacity_total, s_acctbal >= 0 AS active
FROM {supplier}"""

CUSTOMER_ORDERS_SQL = """
SELECT concat('order-', CAST(o_orderkey AS STRING)) AS order_id,
       concat('customer-', CAST(o_custkey AS STRING)) AS customer_id,
       o_orderpriority AS service_level,
       CAST(o_orderkey % 9 AS INT) AS package_count,
       CAST(o_totalprice AS DECIMAL(12,2)) AS order_value,
       o_orderdate AS order_created_at, o_orderdate + INTERVAL '4' HOUR AS promised_delivery_at
FROM {orders}"""

SHIPMENTS_SQL = """
SELECT concat('shipment-', CAST(o_orderkey AS STRING)) AS shipment_id,
       concat('order-', CAST(o_orderkey AS STRING)) AS order_id,
       CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'PENDING' ELSE 'OPEN' END AS shipment_status,
       o_orderdate + INTERVAL '60' DAY AS created_at
FROM {orders}"""

# A pending shipment has not been planned yet, so its deliveries have no plan row.
DELIVERY_PLANS_SQL = """
SELECT concat('delivery-', CAST(o_orderkey AS STRING)) AS delivery_id,
       concat('shipment-', CAST(o_orderkey AS STRING)) AS shipment_id,
       concat('driver-', CAST(o_custkey % 10 AS STRING)) AS driver_id,
       o_orderdate + INTERVAL '30' DAY AS planned_departure_at,
       o_orderdate + INTERVAL '31' DAY AS planned_arrival_at,
       CAST(8.5 + (o_orderkey % 24) * 2.25 AS DECIMAL(12,2)) AS planned_distance_km
FROM {orders} WHERE o_orderstatus <> 'P'"""

# Where each delivery is planned to pass: its depot, a stop on the way and its destination.
PLANNED_STOPS_SQL = """
SELECT concat('delivery-', CAST(o_orderkey AS STRING)) AS delivery_id, stop,
       CAST(CASE stop WHEN 0 THEN 40 + (o_custkey % 25) * 0.01 WHEN 1 THEN 40.05 ELSE 40 + (o_orderkey % 90) * 0.001 END AS DOUBLE) AS latitude,
       CAST(CASE stop WHEN 0 THEN 49 + (o_custkey % 25) * 0.01 WHEN 1 THEN 49 + (o_orderkey % 100) * 0.001 ELSE 49.1 END AS DOUBLE) AS longitude
FROM {orders} JOIN (SELECT 0 AS pending, 0 AS stop UNION ALL SELECT 0, 1 UNION ALL SELECT 0, 2 UNION ALL SELECT 1, 0 UNION ALL SELECT 1, 1) AS stops
     ON pending = CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END"""

VIEWS = {
    "transportation_costs": (COSTS_SQL, ["lineitem", "supplier", "nation", "region"]),
    "vehicle_telemetry": (TELEMETRY_SQL, ["events"]),
    "warehouses": (WAREHOUSES_SQL, ["nation", "region"]),
    "vehicles": (VEHICLES_SQL, ["supplier"]),
    "customer_orders": (CUSTOMER_ORDERS_SQL, ["orders"]),
    "shipments": (SHIPMENTS_SQL, ["orders"]),
    "delivery_plans": (DELIVERY_PLANS_SQL, ["orders"]),
    "planned_stops": (PLANNED_STOPS_SQL, ["orders"]),
}


# What one micro-batch of the delivery stream reads at most.
STREAM_BYTES = 256 << 30
# What a task makes JSON of or parses: in wide rows a few hundred megabytes, which it sorts in memory.
EVENTS_PER_TASK = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_bytes: int | None = None) -> DataFrame:
    """The same table as a file stream, oldest file first.

    The glob makes Spark accept a single file as well as a folder of files. ``max_bytes``
    bounds a micro-batch.
    """
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def _view(
    spark: SparkSession,
    sf_dir: str,
    sql: str,
    tables: Iterable[str],
    streamed: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    inputs = {
        name: stream_table(spark, sf_dir, name, max_bytes) if name == streamed else table(spark, sf_dir, name)
        for name in tables
    }
    return spark.sql(sql, **inputs)


def delivery_events(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    sql, tables = events_sql(columns)
    return _view(spark, sf_dir, sql, tables)


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that the events are dealt to."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "lineitem").count() // EVENTS_PER_TASK))


def _with_orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left")


def _events_of(spark: SparkSession, sf_dir: str, dealt: DataFrame) -> DataFrame:
    """All columns of the events, made of line items that hold the columns of their orders."""
    sql, _ = events_sql(EVENT_LINE_COLUMNS | EVENT_ORDER_COLUMNS)
    small = {name: table(spark, sf_dir, name) for name in ("supplier", "nation", "region")}
    return spark.sql(sql.replace("LEFT JOIN {orders} ON l_orderkey = o_orderkey ", ""), lineitem=dealt, **small)


def delivery_events_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the events, dealt to tasks of about as many events each, for work that is bound by the events' own cost.

    After the join Spark packs the rows by their bytes into about as many tasks as there are cores, and a task too many doubles
    the time; tables of few row groups are read by few tasks.
    """
    dealt = _with_orders(spark, sf_dir, table(spark, sf_dir, "lineitem")).repartition(_tasks(spark, sf_dir), "l_orderkey", "l_linenumber", "l_partkey")
    return _events_of(spark, sf_dir, dealt)


def delivery_event_stream(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All columns of the events as a stream, dealt by month to files of about as many events each.

    What is dealt are the line items with the columns of their orders, a tenth as wide as the events made of them. A month is
    split by order, as often as it takes to even the files out. They are written to ``folder`` before the stream starts: a micro-batch
    holds the shuffle files of its own plan until it has written all its tables, and with a written source it has none. Start
    the stream inside ``file_per_task``.
    """
    folder = folder or shared_dir(spark, "arriving")
    tasks = _tasks(spark, sf_dir)
    lines = _with_orders(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    sql, _ = events_sql()
    dealt = lines.select(*[c for c in lines.columns if c in sql]).repartition(
        tasks, F.trunc("l_shipdate", "month"), F.pmod(F.xxhash64("l_orderkey"), F.lit(-(-tasks // 10)))
    )
    dealt.write.parquet(folder, compression="zstd")
    free_shuffles(spark)
    return _events_of(spark, sf_dir, spark.readStream.schema(dealt.schema).option("maxBytesPerTrigger", STREAM_BYTES).parquet(folder))


@contextmanager
def file_per_task(spark: SparkSession) -> Iterator[None]:
    """Scans of queries started inside read a file of ordinary size in one task, and no two in the same."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def view(spark: SparkSession, sf_dir: str, name: str, *, streaming: str | None = None) -> DataFrame:
    sql, tables = VIEWS[name]
    return _view(spark, sf_dir, sql, tables, streaming)
