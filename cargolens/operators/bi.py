"""Dashboard queries: default metrics, charts, pivot and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.numbers import mean

# Fixed value: row limit of a chart on a dashboard. A query takes no limit unless its caller passes one.
ROW_LIMIT = 1000


@dataclass(frozen=True)
class Chart:
    view: str
    metrics: tuple[str, ...]
    groupby: tuple[str, ...] = ()
    columns: str | None = None
    hourly: str | None = None


# The charts of the two dashboards.
CHARTS: dict[str, Chart] = {
    "status_overview": Chart("status_overview", ("event_count",), ("status",)),
    "delay_pivot": Chart("delay_by_region", ("delay_rate", "avg_delay_minutes"), ("region",), columns="service_level"),
    "vehicle_utilization": Chart(
        "vehicle_utilization", ("avg_utilization_ratio",), ("vehicle_id", "active_status", "route_id")
    ),
    "warehouse_kpi": Chart(
        "warehouse_daily_kpi",
        (
            "completed_deliveries",
            "delayed_deliveries",
            "on_time_deliveries",
            "delay_rate",
            "on_time_rate",
            "total_order_value",
        ),
        ("business_date", "region", "warehouse_id"),
    ),
    "hourly_volume": Chart("event_volume", ("event_count",), ("event_type",), hourly="event_hour"),
    "actual_cost": Chart("cost_performance", ("actual_cost",)),
    "cost_variance": Chart("cost_performance", ("cost_variance",)),
    "cost_per_delivery": Chart("cost_performance", ("cost_per_delivery",)),
    "cost_breakdown": Chart(
        "cost_performance",
        ("fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost"),
        ("business_date",),
    ),
    "route_cost": Chart(
        "cost_performance", ("actual_cost", "cost_per_delivery", "cost_variance"), ("route_id", "region")
    ),
    "warehouse_cost": Chart("cost_performance", ("actual_cost",), ("warehouse_id", "region")),
    "route_risk": Chart(
        "cost_performance",
        ("actual_cost", "delay_rate", "avg_delay_minutes", "cost_delay_risk_score"),
        ("route_id", "warehouse_id", "region"),
    ),
}

# The dashboards and their filters.
DASHBOARDS = {
    "operations": (
        ("status_overview", "delay_pivot", "vehicle_utilization", "warehouse_kpi", "hourly_volume"),
        (),
    ),
    "cost_and_routes": (
        (
            "actual_cost",
            "cost_variance",
            "cost_per_delivery",
            "cost_breakdown",
            "route_cost",
            "warehouse_cost",
            "route_risk",
        ),
        ("business_date", "warehouse_id", "region", "route_id"),
    ),
}


def default_aggregate(metric: str) -> str:
    return "avg" if metric.startswith("avg_") or metric.endswith("_rate") else "sum"


def metric_column(df: DataFrame, metric: str, aggregate: str | None = None) -> Column:
    kind = aggregate or default_aggregate(metric)
    return (mean(df, metric) if kind == "avg" else F.sum(metric)).alias(metric)


def chart(
    df: DataFrame,
    spec: Chart,
    *,
    pivot_values: Sequence[str] | None = None,
    aggregates: Mapping[str, str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One chart query. ``aggregates`` overrides the default of single metrics.

    A limited chart is ordered by its first metric and then by its keys, so the rows
    it shows are the same every time.
    """
    overrides = aggregates or {}
    keys = list(spec.groupby)
    if spec.hourly:
        df = df.withColumn(spec.hourly, F.date_trunc("hour", F.col(spec.hourly)))
        keys = [spec.hourly, *keys]
    metrics = [metric_column(df, m, overrides.get(m)) for m in spec.metrics]
    grouped = df.groupBy(*keys)
    if spec.columns:
        # Spark names pivoted columns <value>_<metric>.
        grouped = grouped.pivot(spec.columns, sorted(pivot_values)) if pivot_values else grouped.pivot(spec.columns)
        result, order = grouped.agg(*metrics), keys
    else:
        result, order = grouped.agg(*metrics), [F.desc(spec.metrics[0]), *[F.asc(k) for k in keys]]
    return result if limit is None else result.orderBy(*order).limit(limit)


def dashboard(df: DataFrame, charts: Mapping[str, Chart]) -> DataFrame:
    """Charts of one view in one pass over it: a row per chart and group, by grouping sets.

    Columns are ``chart``, all group columns and all metrics; null where a chart does not have them. The grouping id, not the
    nulls, tells the charts apart, so groups whose key is null are rows like others. Charts with the same keys share
    their groups. An empty view has no rows, totals included. No pivots and no hourly charts.
    """
    if odd := [name for name, spec in charts.items() if spec.columns or spec.hourly]:
        raise ValueError(f"not a plain grouping: {odd}")
    keys = list(dict.fromkeys(k for spec in charts.values() for k in spec.groupby))
    metrics = list(dict.fromkeys(m for spec in charts.values() for m in spec.metrics))
    sets = list(dict.fromkeys(tuple(k for k in keys if k in spec.groupby) for spec in charts.values()))
    # A grouping id has a bit per key, the first one highest, set where the key is left out.
    number = lambda cols: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols)
    grouped = df.groupingSets([list(s) for s in sets], *keys).agg(*[metric_column(df, m) for m in metrics], F.grouping_id().alias("gid"))
    shown = F.array(*[F.struct(F.lit(number(spec.groupby)).cast("long").alias("gid"), F.lit(name).alias("chart")) for name, spec in charts.items()])
    each = grouped.select("*", F.explode(F.filter(shown, lambda c: c["gid"] == F.col("gid"))).alias("c"))
    having = lambda m: [name for name, spec in charts.items() if m in spec.metrics]
    return each.select(F.col("c.chart").alias("chart"), *keys, *[F.when(F.col("c.chart").isin(*having(m)), F.col(m)).alias(m) for m in metrics])


def apply_filters(
    df: DataFrame,
    *,
    date_column: str = "business_date",
    start: date | None = None,
    end: date | None = None,
    selections: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Dashboard filters: a half-open time range and multi-select values; empty means all."""
    if start is not None:
        df = df.filter(F.col(date_column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(date_column) < F.lit(end))
    for column, values in (selections or {}).items():
        if values:
            df = df.filter(F.col(column).isin(*values))
    return df
