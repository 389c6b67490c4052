from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargolens.functions.numbers import mean, ratio_or_zero
from cargolens.operators import costs
from cargolens.operators import events as ev

SCHEMA = (
    "cost_id string, business_date date, delivery_id string, route_id string, vehicle_id string, warehouse_id string, "
    "region string, planned_distance_km decimal(12,2), actual_distance_km decimal(12,2), planned_cost decimal(12,2), "
    "fuel_cost decimal(12,2), driver_cost decimal(12,2), toll_cost decimal(12,2), maintenance_cost decimal(12,2), "
    "other_cost decimal(12,2), actual_total_cost decimal(12,2), fuel_liters decimal(12,2), delivery_count int, "
    "vehicle_capacity decimal(12,2), used_capacity decimal(12,2), planned_duration_minutes int, "
    "actual_duration_minutes int, created_at timestamp, updated_at timestamp"
)


def cost(cost_id="a", planned=100, actual=110, km=10, deliveries=11, day=date(2024, 5, 1), route="r1", **more):
    d = Decimal
    row = dict(
        cost_id=cost_id, business_date=day, delivery_id="d1", route_id=route, vehicle_id="v1", warehouse_id="w1",
        region="north", planned_distance_km=d(8), actual_distance_km=d(km), planned_cost=d(planned),
        fuel_cost=d(actual) / 2, driver_cost=d(actual) / 2, toll_cost=d(0), maintenance_cost=d(0), other_cost=d(0),
        actual_total_cost=d(actual), fuel_liters=d(3), delivery_count=deliveries, vehicle_capacity=d(200),
        used_capacity=d(50), planned_duration_minutes=60, actual_duration_minutes=70,
        created_at=datetime(2024, 5, 1), updated_at=datetime(2024, 5, 2),
    )
    return tuple({**row, **more}.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def layers(spark, *rows):
    bronze = costs.bronze(frame(spark, *rows), run_id="r", source_system="test")
    return costs.silver(bronze)


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(ratio_or_zero(F.col("n"), F.col("d"))).collect()] == [0.5, 0.0, 0.0, None]


@pytest.mark.parametrize("xs", [[1.0, float("nan"), 3.0], [1.0, float("inf"), 3.0], [1e-10, 2e-10], [1e30, 1e30], [None, 2.0], [None, None]])
def test_averages_of_doubles_are_plain_ones(spark, xs):
    from cargolens.operators.trends import vehicle_utilization_daily

    rows = [(date(2024, 1, 1), "v", "d", x) for x in xs]
    df = spark.createDataFrame(rows, "business_date date, vehicle_id string, delivery_id string, utilization_ratio double")
    found = vehicle_utilization_daily(df).first()["avg_utilization_ratio"]
    given = [x for x in xs if x is not None]
    assert str(found) == str(sum(given) / len(given) if given else None)


def test_means_of_decimals_and_integers_are_exact(spark):
    df = spark.createDataFrame([(1, Decimal("0.10")), (2, Decimal("0.20")), (None, None)], "i int, d decimal(4,2)")
    assert tuple(df.agg(mean(df, "i"), mean(df, "d")).first()) == (1.5, 0.15)


def test_silver_by_hand(spark):
    a, b = layers(spark, cost("a"), cost("b", 0, 50, 0, 0)).orderBy("cost_id").collect()
    assert [a[c] for c in ("cost_variance", "cost_variance_pct", "cost_per_km", "cost_per_delivery")] == [10, 0.1, 11, 10]
    assert [b[c] for c in ("cost_variance", "cost_variance_pct", "cost_per_km", "cost_per_delivery")] == [50, 0, 0, 0]
    assert (a["distance_variance_km"], a["distance_variance_pct"], a["duration_variance_minutes"]) == (2.0, 0.25, 10.0)
    assert (a["fuel_cost_pct"], a["vehicle_utilization_pct"]) == (0.5, 0.25)
    assert (a["_pipeline_run_id"], a["_source_system"], a["_batch_date"]) == ("r", "test", date(2024, 5, 1))


def test_gold_takes_ratios_from_sums(spark):
    row = costs.gold(layers(spark, cost("a"), cost("b", 0, 50, 0, 0), cost("b", 0, 0, 0, 0))).first()
    assert (row["cost_record_count"], row["total_deliveries"]) == (2, 11)
    assert (row["actual_cost"], row["planned_cost"], row["cost_variance"]) == (160, 100, 60)
    assert (row["cost_variance_pct"], row["cost_per_km"]) == (0.6, 16.0)
    assert row["cost_per_delivery"] == pytest.approx(160 / 11)


def test_gold_keeps_a_group_with_a_null_key(spark):
    rows = costs.gold(layers(spark, cost("a", route=None), cost("b", route=None), cost("c"))).collect()
    assert {(r["route_id"], r["cost_record_count"]) for r in rows} == {(None, 2), ("r1", 1)}


def test_gold_sums_equal_silver_sums(spark, sf_dir):
    from cargolens.sources.adapters import view

    silver = costs.silver(costs.bronze(view(spark, sf_dir, "transportation_costs"), run_id="r", source_system="s"))
    expected = silver.agg(F.sum("actual_total_cost"), F.sum("planned_cost"), F.sum("delivery_count")).first()
    found = costs.gold(silver).agg(F.sum("actual_cost"), F.sum("planned_cost"), F.sum("total_deliveries")).first()
    assert tuple(found) == tuple(expected)


def test_bronze_batch_date_is_the_runs_date(spark):
    row = costs.bronze(frame(spark, cost()), run_id="r", source_system="s", batch_date=date(2024, 6, 1)).first()
    assert (row["_batch_date"], row["business_date"]) == (date(2024, 6, 1), date(2024, 5, 1))


def test_route_day_without_events_gets_zeros(spark):
    gold = costs.gold(layers(spark, cost("a"), cost("b", route="r2")))
    events = spark.createDataFrame(
        [(datetime(2024, 5, 1, 8), "w1", "north", "r1", "d1", 5), (datetime(2024, 5, 1, 9), "w1", "north", "r1", "d1", 0)],
        "event_timestamp timestamp, warehouse_id string, region string, route_id string, delivery_id string, delay_minutes int",
    )
    rows = {r["route_id"]: r for r in costs.cost_performance(gold, ev.route_delay(events)).collect()}
    assert (rows["r1"]["operational_delivery_count"], rows["r1"]["delayed_delivery_count"]) == (1, 1)
    assert (rows["r1"]["delay_rate"], rows["r1"]["avg_delay_minutes"]) == (0.5, 2.5)
    assert rows["r1"]["cost_delay_risk_score"] == pytest.approx(0.1 + 0.5)
    assert [rows["r2"][c] for c in ("operational_delivery_count", "delayed_delivery_count", "avg_delay_minutes", "delay_rate")] == [0] * 4
    assert rows["r2"]["cost_delay_risk_score"] == pytest.approx(0.1)


def test_cost_view_reads_the_top_version(spark):
    gold = costs.gold(layers(spark, cost("a")))
    versions = gold.withColumn("version", F.lit(1)).unionByName(gold.withColumn("version", F.lit(2)))
    delays = ev.route_delay(
        spark.createDataFrame(
            [], "event_timestamp timestamp, warehouse_id string, region string, route_id string, delivery_id string, delay_minutes int"
        )
    )
    assert [r["version"] for r in costs.cost_performance(versions, delays).collect()] == [2]
