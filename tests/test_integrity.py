from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolens.operators import integrity, lifecycle, trends
from cargolens.functions.geo import haversine_km
from cargolens.functions.times import month_key, sink_text
from cargolens.sources.schemas import STATUS_ORDER

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("chunk", ["hour", "day", "year"])
def test_previous_value_equals_a_plain_lag_with_a_hot_key(spark, chunk):
    """One key, a null one at that, holds a third of the rows; instants repeat and days are skipped."""
    rows = []
    for i in range(3000):
        key = None if i % 3 == 0 else f"k{i % 97}"
        at = T0 + timedelta(minutes=((i * 7919) % 1500) * 13, days=(i % 5) * 3)
        rows.append((key, at, i, STATUS_ORDER[(i * 31) % 5]))
    df = spark.createDataFrame(rows, "k string, at timestamp, i int, status string")
    found = integrity.with_previous(df, "k", "at", ["i"], "status", "previous", chunk=chunk)
    expected, last = {}, {}
    for key, at, i, status in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        expected[i] = last.get(key)
        last[key] = status
    assert {r["i"]: r["previous"] for r in found.collect()} == expected


@pytest.mark.parametrize(
    ("before", "after", "ok"),
    [(None, "DELIVERED", True), ("ORDER_LOADED", "IN_TRANSIT", True), ("IN_TRANSIT", "IN_TRANSIT", True), ("DELIVERED", "IN_TRANSIT", False), (None, "LOST", False), ("LOST", "DELIVERED", False)],
)
def test_status_steps(spark, before, after, ok):
    df = spark.createDataFrame([(before, after)], "a string, b string")
    assert df.select(integrity.is_forward(F.col("a"), F.col("b"), STATUS_ORDER)).first()[0] is ok


def test_orphans_and_coverage(spark):
    child = spark.createDataFrame([("v1", "w1"), ("v1", "w9"), ("v2", None), ("v3", "w9")], "vehicle_id string, warehouse_id string")
    vehicles = spark.createDataFrame([("v1",), ("v2",)], "vehicle_id string")
    warehouses = spark.createDataFrame([("w1",)], "id string")
    found = integrity.orphans(child, {"vehicle_id": (vehicles, "vehicle_id"), "warehouse_id": (warehouses, "id")})
    assert {tuple(r) for r in found.collect()} == {("vehicle_id", 1), ("warehouse_id", 2)}
    assert tuple(integrity.coverage(child, vehicles, ["vehicle_id"]).first()) == (3, 2, 4, 3)
    assert tuple(integrity.coverage(child.limit(0), vehicles, ["vehicle_id"]).first()) == (0, 0, 0, 0)


def test_duplicates_and_order_of_arrival(spark):
    df = spark.createDataFrame(
        [("d1", "VEHICLE_DEPARTED", T0), ("d1", "DELIVERED", T0 - timedelta(hours=1)), ("d1", "DELIVERED", T0), ("d2", "DELIVERED", T0)],
        "delivery_id string, status string, event_timestamp timestamp",
    )
    assert [tuple(r) for r in integrity.duplicate_confirmations(df).collect()] == [("d1", 2)]
    assert [r["delivery_id"] for r in integrity.arrivals_before_departure(df).collect()] == ["d1"]
    shipments = spark.createDataFrame([("d1", T0)], "shipment_id string, created_at timestamp")
    early = integrity.events_before_creation(df.withColumnRenamed("delivery_id", "shipment_id"), shipments)
    assert early.count() == 1


def test_retention_boundary(spark):
    df = spark.createDataFrame([(T0,), (T0 + timedelta(seconds=1),)], "event_timestamp timestamp_ntz")
    kept = lifecycle.retain(df, T0 + timedelta(days=30), 30)
    assert [r[0] for r in kept.collect()] == [T0 + timedelta(seconds=1)]


def test_retention_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(T0,)], "event_timestamp timestamp_ntz").write.parquet(str(tmp_path / "t"))
    plan = lifecycle.retain(spark.read.parquet(str(tmp_path / "t")), T0, 30)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_timestamp" in plan


def test_incremental_and_high_water_mark(spark):
    df = spark.createDataFrame([(T0,), (T0 + timedelta(days=1),), (T0 - timedelta(days=1),), (None,)], "updated_at timestamp")
    assert lifecycle.incremental(df, "updated_at", None).count() == 4
    assert lifecycle.incremental(df, "updated_at", T0).count() == 3  # the mark itself, later ones and unknown times
    mark = lifecycle.high_water_mark(df, "updated_at")
    assert mark == T0 + timedelta(days=1) and lifecycle.incremental(df, "updated_at", mark).count() == 2
    assert lifecycle.high_water_mark(df.limit(0), "updated_at") is None


def test_freshness_and_readiness(spark):
    df = spark.createDataFrame([(T0, T0.date())], "at timestamp, business_date date")
    assert tuple(lifecycle.freshness(df, "at", T0 + timedelta(seconds=300), 300).first()) == (1, T0, 300, 1)
    assert lifecycle.freshness(df, "at", T0 + timedelta(seconds=301), 300).first()["is_fresh"] == 0
    assert lifecycle.freshness(df.limit(0), "at", T0, 300).first()["is_fresh"] == 0
    assert lifecycle.readiness(df, T0.date()).first()["row_count"] == 1
    with pytest.raises(RuntimeError, match="no rows in x"):
        lifecycle.require_rows(df.limit(0), "x")


def test_sink_text_and_month(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 3, 4, 5, 6, 789000),), (None,)], "at timestamp")
    text = [r[0] for r in df.select(sink_text(F.col("at"))).collect()]
    assert text == ["2024-02-03 04:05:06.789", None]
    assert df.select(sink_text(F.col("at"), epoch_when_null=True)).collect()[1][0] == "1970-01-01 00:00:00.000"
    assert df.select(month_key(F.col("at"))).first()[0] == "202402"


def test_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (40.0, 49.0, 40.0, 49.0)], "a double, b double, c double, d double")
    half, none = [r[0] for r in df.select(haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert half == pytest.approx(20015.087, abs=0.001) and none == 0.0


def test_delay_signals(spark):
    state = spark.createDataFrame(
        [
            ("late", "w1", "IN_TRANSIT", T0, T0 + timedelta(minutes=25), 0.0, 0.0, 10.0),
            ("far", "w1", "IN_TRANSIT", None, None, 0.0, 1.0, 10.0),
            ("done", "w1", "DELIVERED", T0, T0 + timedelta(minutes=25), 0.0, 1.0, 10.0),
        ],
        "delivery_id string, warehouse_id string, status string, planned_arrival_timestamp timestamp, "
        "estimated_arrival_timestamp timestamp, latitude double, longitude double, planned_distance_km double",
    ).withColumns({"vehicle_id": F.lit("v"), "route_id": F.lit("r")})
    depots = spark.createDataFrame([("w1", 0.0, 0.0)], "warehouse_id string, latitude double, longitude double")
    found = trends.delay_signals(state, depots, delayed_after_minutes=15, deviation_km=5.0, speed_kmh=40.0)
    rows = {r["delivery_id"]: r for r in found.collect()}
    assert set(rows) == {"late", "far"}
    assert (rows["late"]["arrival_delay_minutes"], rows["late"]["eta_minutes"], rows["late"]["is_late"]) == (25.0, 15.0, 1)
    assert (rows["far"]["is_late"], rows["far"]["is_off_route"], rows["far"]["eta_minutes"]) == (0, 1, 0.0)
    assert trends.problem_shipments(found).count() == 2


def test_top_routes_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "route_id string, x int")
    assert [r["route_id"] for r in trends.top_routes(df, "m", 2, F.sum("x")).collect()] == ["c", "a"]
