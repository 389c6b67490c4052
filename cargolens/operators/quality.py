"""Metadata-driven quality rules, all evaluated in one pass over the data."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 0.01


def operands(formula: str) -> list[str]:
    """Column names that a sum such as ``a + b`` adds up."""
    return re.findall(r"[^\s+]+", formula)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _equality(quality: Mapping) -> dict[str, list[str]]:
    section = quality.get("equality", {})
    if not isinstance(section, Mapping):
        return {}
    formulas = {str(t): r.get("formula") for t, r in section.items() if isinstance(r, Mapping)}
    return {target: operands(formula) for target, formula in formulas.items() if formula}


def referenced_columns(quality: Mapping) -> set[str]:
    equality = _equality(quality)
    names = {*quality.get("not_null", []), *quality.get("non_negative", []), *quality.get("accepted_values", {})}
    # An equality target must exist even when its formula is empty.
    section = quality.get("equality", {})
    names |= set(section) if isinstance(section, Mapping) else set()
    return names.union(*equality.values()) if equality else names


def check_columns(dataset: str, columns: Sequence[str], quality: Mapping) -> None:
    missing = sorted(referenced_columns(quality) - set(columns))
    if missing:
        raise ValueError(f"{dataset}: quality rules name missing columns: {', '.join(missing)}")


def rules(quality: Mapping) -> dict[str, Column]:
    """Rule name to its failing condition. A null never fails a comparison."""
    found: dict[str, Column] = {}
    if quality.get("not_null"):
        found["not_null"] = _any([F.col(c).isNull() for c in quality["not_null"]])
    if quality.get("non_negative"):
        found["non_negative"] = _any([F.col(c) < 0 for c in quality["non_negative"]])
    for target, parts in _equality(quality).items():
        if not parts:
            raise ValueError("an equality formula needs at least one column")
        total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in parts])
        found[f"equality:{target}"] = F.abs(F.col(target).cast("double") - total) > TOLERANCE
    for column, values in quality.get("accepted_values", {}).items():
        found[f"accepted_values:{column}"] = ~F.col(column).isin(*values)
    return found


def failed_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(rule, failed_count) for every rule, from a single aggregate row."""
    names = list(conditions)
    row = df.agg(*[F.count_if(conditions[name]).alias(f"r{i}") for i, name in enumerate(names)])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("failed_count")) for i, name in enumerate(names)]
    return row.select(F.inline(F.array(*pairs)))


def enforce(df: DataFrame, dataset: str, quality: Mapping) -> DataFrame:
    """The counts of all rules; raises, naming every rule that any row breaks.

    The counts are one aggregate row, so what is held here does not grow with the data.
    """
    check_columns(dataset, df.columns, quality)
    conditions = rules(quality)
    found = failed_counts(df, conditions).collect() if conditions else []
    counts = df.sparkSession.createDataFrame(found, "rule string, failed_count bigint")
    broken = {r["rule"]: r["failed_count"] for r in found if r["failed_count"]}
    if broken:
        raise ValueError(f"{dataset}: rows break {len(broken)} of {len(conditions)} quality rules: {broken}")
    return counts


def source_checks() -> dict[str, Column]:
    """CHECK constraints of the cost source table, as failing conditions."""
    amounts = ["planned_distance_km", "actual_distance_km", "planned_cost", "fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost", "actual_total_cost", "fuel_liters", "used_capacity"]
    counts = ["delivery_count", "planned_duration_minutes", "actual_duration_minutes"]
    parts = ["fuel_cost", "driver_cost", "toll_cost", "maintenance_cost", "other_cost"]
    total = reduce(lambda a, b: a + b, [F.col(c) for c in parts])
    return {
        "used_within_capacity": F.col("used_capacity") > F.col("vehicle_capacity"),
        "total_is_sum_of_parts": F.col("actual_total_cost") != total,
        "capacity_positive": F.col("vehicle_capacity") <= 0,
        **{f"{c}_not_negative": F.col(c) < 0 for c in (*amounts, *counts)},
    }


def vehicle_checks() -> dict[str, Column]:
    return {"capacity_total_positive": F.col("capacity_total") <= 0}


def order_checks() -> dict[str, Column]:
    return {
        "order_value_not_negative": F.col("order_value") < 0,
        "package_count_positive": F.col("package_count") <= 0,
        "promised_after_created": F.col("promised_delivery_at") <= F.col("order_created_at"),
    }


def plan_checks() -> dict[str, Column]:
    return {
        "arrival_after_departure": F.col("planned_arrival_at") <= F.col("planned_departure_at"),
        "distance_not_negative": F.col("planned_distance_km") < 0,
    }


def event_checks(statuses: Sequence[str], late_after: str = "1 day") -> dict[str, Column]:
    """Row checks wanted of delivery events; the keyed ones live in ``integrity``."""
    used, total = F.col("capacity_used"), F.col("capacity_total")
    return {
        "missing_id": _any(
            [~F.coalesce(F.col(c).rlike(r"\S"), F.lit(False)) for c in ("event_id", "delivery_id", "vehicle_id")]
        ),
        "missing_timestamp": F.col("event_timestamp").isNull(),
        "invalid_position": (F.abs("latitude") > 90) | (F.abs("longitude") > 180),
        "unknown_status": ~F.coalesce(F.col("status").isin(*statuses), F.lit(False)),
        "negative_value": F.col("order_value") < 0,
        "impossible_capacity": (used < 0) | (total <= 0) | (used > total),
        "estimate_far_behind_plan": F.col("estimated_arrival_timestamp")
        > F.col("planned_arrival_timestamp") + F.expr(f"INTERVAL '{late_after}'"),
    }
