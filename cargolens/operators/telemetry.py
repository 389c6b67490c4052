"""Vehicle telemetry: admission, latest state, health alerts and five-minute metrics."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.times import epoch_millis
from cargolens.operators.latest import latest_by_key
from cargolens.sources.schemas import FLEET_STATE_COLUMNS, TELEMETRY_COLUMNS


@dataclass(frozen=True)
class AlertLimits:
    """Inclusive alert thresholds."""

    hot_engine_c: float = 105.0
    low_fuel_pct: float = 15.0
    overspeed_kmh: float = 100.0

    @classmethod
    def of(cls, processing: Mapping) -> AlertLimits:
        """Limits from an application's settings; a missing one keeps its default."""
        return cls(
            float(processing.get("engine_temperature_threshold_c", cls.hot_engine_c)),
            float(processing.get("low_fuel_threshold_pct", cls.low_fuel_pct)),
            float(processing.get("overspeed_threshold_kmh", cls.overspeed_kmh)),
        )


WINDOW = "5 minutes"


def admit(telemetry: DataFrame) -> DataFrame:
    """Version-1 telemetry only; every output branch shares this filter."""
    return telemetry.filter((F.col("schema_version") == 1) & (F.col("event_type") == "VEHICLE_TELEMETRY"))


def raw(admitted: DataFrame) -> DataFrame:
    return admitted.select(*TELEMETRY_COLUMNS)


def state_projection(admitted: DataFrame) -> DataFrame:
    return admitted.select(*FLEET_STATE_COLUMNS).withColumnRenamed("event_timestamp", "last_event_timestamp").withColumn(
        "version", epoch_millis(F.col("last_event_timestamp"))
    )


FLEET_STATE_ORDER = ["version", "last_event_timestamp", "event_id"]


def fleet_state(admitted: DataFrame) -> DataFrame:
    return latest_by_key(state_projection(admitted), ["vehicle_id"], FLEET_STATE_ORDER)


def _alert(kind: str, severity: str, observed: str, limit: float) -> Column:
    return F.struct(
        F.lit(kind).alias("alert_type"),
        F.lit(severity).alias("severity"),
        F.col(observed).cast("double").alias("observed_value"),
        F.lit(float(limit)).alias("threshold"),
    )


def health_alerts(admitted: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """One alert per offending event: engine temperature first, then fuel, then speed."""
    hot = F.col("engine_temperature_c") >= limits.hot_engine_c
    low = F.col("fuel_level_pct") <= limits.low_fuel_pct
    fast = F.col("speed_kmh") >= limits.overspeed_kmh
    alert = (
        F.when(hot, _alert("ENGINE_TEMPERATURE_HIGH", "critical", "engine_temperature_c", limits.hot_engine_c))
        .when(low, _alert("LOW_FUEL", "warning", "fuel_level_pct", limits.low_fuel_pct))
        .when(fast, _alert("OVERSPEED", "warning", "speed_kmh", limits.overspeed_kmh))
    )
    return (
        admitted.filter(hot | low | fast)
        .withColumn("alert", alert)
        .select("event_id", "vehicle_id", "event_timestamp", "alert.*")
    )


def _metrics(limits: AlertLimits) -> list[Column]:
    return [
        F.max("engine_temperature_c").alias("max_engine_temperature_c"),
        F.count_if(F.col("speed_kmh") >= limits.overspeed_kmh).alias("overspeed_vehicle_count"),
        F.count_if(F.col("fuel_level_pct") <= limits.low_fuel_pct).alias("low_fuel_vehicle_count"),
    ]


def fleet_metrics(admitted: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Five-minute tumbling windows over a bounded input."""
    return (
        admitted.groupBy(F.window("event_timestamp", WINDOW).alias("w"))
        .agg(
            F.count_distinct("vehicle_id").alias("active_vehicle_count"),
            F.avg("speed_kmh").alias("avg_speed_kmh"),
            F.avg("fuel_level_pct").alias("avg_fuel_level_pct"),
            *_metrics(limits),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def fleet_metrics_stream(admitted: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """The same windows over a watermarked stream.

    A first aggregation per (window, vehicle) and a second per window: the distinct
    count is exact, no group holds a list of its vehicles, and the state of a busy
    window is spread over the vehicles.
    """
    per_vehicle = admitted.groupBy(F.window("event_timestamp", WINDOW).alias("w"), "vehicle_id").agg(*_sums(limits))
    return (
        per_vehicle.groupBy(F.window(F.window_time("w"), WINDOW).alias("w"))
        .agg(*_of_vehicles())
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def _sums(limits: AlertLimits) -> list[Column]:
    return [
        F.sum("speed_kmh").alias("speed_sum"),
        F.count("speed_kmh").alias("speed_n"),
        F.sum("fuel_level_pct").alias("fuel_sum"),
        F.count("fuel_level_pct").alias("fuel_n"),
        *_metrics(limits),
    ]


def _of_vehicles() -> list[Column]:
    """A window's metrics from one row per vehicle."""

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total), F.sum(n))

    return [
        F.count("vehicle_id").alias("active_vehicle_count"),  # a missing vehicle id is no vehicle
        mean("speed_sum", "speed_n").alias("avg_speed_kmh"),
        mean("fuel_sum", "fuel_n").alias("avg_fuel_level_pct"),
        F.max("max_engine_temperature_c").alias("max_engine_temperature_c"),
        F.sum("overspeed_vehicle_count").alias("overspeed_vehicle_count"),
        F.sum("low_fuel_vehicle_count").alias("low_fuel_vehicle_count"),
    ]


def window_partials(admitted: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Sums per (window, vehicle) that add up over any split of the rows."""
    parts = admitted.groupBy(F.window("event_timestamp", WINDOW).alias("w"), "vehicle_id").agg(*_sums(limits))
    return parts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")


def metrics_of_partials(partials: DataFrame) -> DataFrame:
    """Window metrics from partial sums of several batches: exact, distinct vehicles included."""
    window = ["window_start", "window_end"]
    added = ["speed_sum", "speed_n", "fuel_sum", "fuel_n", "overspeed_vehicle_count", "low_fuel_vehicle_count"]
    merged = partials.groupBy(*window, "vehicle_id").agg(
        *[F.sum(c).alias(c) for c in added], F.max("max_engine_temperature_c").alias("max_engine_temperature_c")
    )
    return merged.groupBy(*window).agg(*_of_vehicles())


def versioned_metrics(metrics: DataFrame) -> DataFrame:
    """A window's version is its start, so a re-emitted window replaces itself."""
    return metrics.withColumn("version", epoch_millis(F.col("window_start")))
