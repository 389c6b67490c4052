"""Transportation cost: bronze, silver and gold layers, and the cost-versus-delay view."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.numbers import mean, ratio_or_zero
from cargolens.operators.events import ROUTE_KEYS
from cargolens.operators.latest import latest_by_key

COST_PARTS = ["fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost"]


def number(name: str) -> Column:
    return F.col(name).cast("double")


def bronze(
    source: DataFrame, *, run_id: str, source_system: str, ingested_at: Column | None = None, batch_date: date | None = None
) -> DataFrame:
    """Source rows plus audit columns."""
    business_date = F.col("business_date").cast("date")
    return source.withColumns(
        {
            "business_date": business_date,
            "_ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
            "_pipeline_run_id": F.lit(run_id),
            "_source_system": F.lit(source_system),
            "_batch_date": F.lit(batch_date) if batch_date else business_date,
        }
    )


def silver(bronze_rows: DataFrame) -> DataFrame:
    """Row-level metrics, computed as doubles."""
    actual, planned = number("actual_total_cost"), number("planned_cost")
    cost_gap = actual - planned
    distance_gap = number("actual_distance_km") - number("planned_distance_km")
    return bronze_rows.withColumns(
        {
            "cost_variance": cost_gap,
            "cost_variance_pct": ratio_or_zero(cost_gap, planned),
            "distance_variance_km": distance_gap,
            "distance_variance_pct": ratio_or_zero(distance_gap, number("planned_distance_km")),
            "duration_variance_minutes": number("actual_duration_minutes") - number("planned_duration_minutes"),
            "cost_per_km": ratio_or_zero(actual, number("actual_distance_km")),
            "cost_per_delivery": ratio_or_zero(actual, number("delivery_count")),
            "fuel_cost_pct": ratio_or_zero(number("fuel_cost"), actual),
            "vehicle_utilization_pct": ratio_or_zero(number("used_capacity"), number("vehicle_capacity")),
        }
    )


def gold(silver_rows: DataFrame) -> DataFrame:
    """Route-day KPI; every ratio is recomputed from the sums.

    The exact distinct count runs as its own narrow aggregation. Beside the sums it
    would force all of them through a shuffle on (route day, cost id), one wide row
    per cost row; apart, the sums combine before they are shuffled and only the id
    travels. The two meet on the route day as one struct, which is equal to itself
    even with a null inside, and a reader that skips the count skips its branch.
    """
    rows = silver_rows.withColumn("_route_day", F.struct(*ROUTE_KEYS))
    sums = rows.groupBy("_route_day").agg(
        F.sum("delivery_count").alias("total_deliveries"),
        F.sum("planned_cost").alias("planned_cost"),
        F.sum("actual_total_cost").alias("actual_cost"),
        *[F.sum(part).alias(part) for part in COST_PARTS],
        F.sum("actual_distance_km").alias("total_distance_km"),
        F.avg("vehicle_utilization_pct").alias("avg_vehicle_utilization_pct"),
        mean(rows, "actual_duration_minutes").alias("avg_delivery_duration_minutes"),
        F.avg("duration_variance_minutes").alias("avg_duration_variance_minutes"),
    )
    ids = rows.groupBy("_route_day").agg(F.count_distinct("cost_id").alias("cost_record_count"))
    totals = sums.join(ids, "_route_day", "left").select("_route_day.*", "*").drop("_route_day")
    actual = number("actual_cost")
    # Decimal money is subtracted as decimal, then divided as double.
    gap = (F.col("actual_cost") - F.col("planned_cost")).cast("double")
    return totals.withColumns(
        {
            "cost_variance": gap,
            "cost_variance_pct": ratio_or_zero(gap, number("planned_cost")),
            "cost_per_km": ratio_or_zero(actual, number("total_distance_km")),
            "cost_per_delivery": ratio_or_zero(actual, number("total_deliveries")),
            "fuel_cost_pct": ratio_or_zero(number("fuel_cost"), actual),
        }
    )


def cost_performance(gold_kpi: DataFrame, delays: DataFrame) -> DataFrame:
    """Cost KPI left-joined with the operational delay of the same route day.

    Both sides are aggregated to the join keys before they meet. A route day without
    events gets zeros, so its risk score is its cost variance alone.
    """
    if "version" in gold_kpi.columns:
        gold_kpi = latest_by_key(gold_kpi, ROUTE_KEYS, ["version"])
    zero_filled = ["operational_delivery_count", "delayed_delivery_count", "avg_delay_minutes", "delay_rate"]
    joined = gold_kpi.join(delays, ROUTE_KEYS, "left").fillna(0, subset=zero_filled)
    return joined.withColumn("cost_delay_risk_score", F.col("cost_variance_pct") + F.col("delay_rate"))
