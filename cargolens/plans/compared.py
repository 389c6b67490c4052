"""Digits of the columns that add up doubles.

The last bits of such a sum depend on the order of the rows. Operators leave them as they are; the registered
queries and their SQL round these columns alike, and only these, so that results can be compared by hash.
"""

from __future__ import annotations

_UTILIZATION = {"avg_vehicle_utilization": 9}
_GOLD = {"avg_vehicle_utilization_pct": 9}
_METRICS = {"avg_speed_kmh": 9, "avg_fuel_level_pct": 9}
_ROUTE_COST = {"cost_per_delivery": 5, "cost_variance": 5}

DIGITS: dict[str, dict[str, int]] = {
    "daily_delivery_kpi": _UTILIZATION,
    "daily_delivery_kpi_dedup": _UTILIZATION,
    "delivery_history_stream": _UTILIZATION | {"total_order_value": 2, "avg_distance_km": 9},
    "warehouse_daily_kpi": _UTILIZATION,
    "cost_gold": _GOLD,
    "cost_gold_for_date": _GOLD,
    "cost_gold_table": _GOLD,
    "cost_performance": _GOLD,
    "cost_gold_incremental": _GOLD,
    "route_deviation": {"deviation_km": 6},
    "fleet_metrics_5m": _METRICS,
    "fleet_metrics_5m_stream": _METRICS,
    "fleet_metrics_corrected_stream": _METRICS,
    "vehicle_utilization_daily": {"avg_utilization_ratio": 9},
    "bi_cost_variance": {"cost_variance": 5},
    "bi_cost_per_delivery": {"cost_per_delivery": 5},
    "bi_cost_per_delivery_avg": {"cost_per_delivery": 5},
    "bi_route_cost": _ROUTE_COST,
    "bi_route_cost_limited": _ROUTE_COST,
    "bi_filtered_cost": _ROUTE_COST,
    "bi_cost_dashboard": _ROUTE_COST | {"delay_rate": 9, "avg_delay_minutes": 9, "cost_delay_risk_score": 5},
    "bi_cost_dashboard_filtered": _ROUTE_COST | {"delay_rate": 9, "avg_delay_minutes": 9, "cost_delay_risk_score": 5},
    "bi_route_risk": {"delay_rate": 9, "avg_delay_minutes": 9, "cost_delay_risk_score": 5},
}
