"""Telemetry outputs as named SQL statements with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cargolens.operators.telemetry import AlertLimits

STATEMENTS = {
    "alerts": """
        SELECT event_id, vehicle_id, event_timestamp, alert.*
        FROM (
          SELECT *,
            CASE
              WHEN engine_temperature_c >= :hot THEN named_struct('alert_type', 'ENGINE_TEMPERATURE_HIGH', 'severity', 'critical',
                   'observed_value', engine_temperature_c, 'threshold', CAST(:hot AS DOUBLE))
              WHEN fuel_level_pct <= :low THEN named_struct('alert_type', 'LOW_FUEL', 'severity', 'warning',
                   'observed_value', fuel_level_pct, 'threshold', CAST(:low AS DOUBLE))
              WHEN speed_kmh >= :fast THEN named_struct('alert_type', 'OVERSPEED', 'severity', 'warning',
                   'observed_value', speed_kmh, 'threshold', CAST(:fast AS DOUBLE))
            END AS alert
          FROM {telemetry}
          WHERE schema_version = 1 AND event_type = 'VEHICLE_TELEMETRY'
            AND (engine_temperature_c >= :hot OR fuel_level_pct <= :low OR speed_kmh >= :fast)
        )""",
    "vehicle_extremes": """
        SELECT vehicle_id, count(*) AS reading_count, max(speed_kmh) AS max_speed_kmh,
               min(fuel_level_pct) AS min_fuel_level_pct, max(engine_temperature_c) AS max_engine_temperature_c,
               count_if(speed_kmh >= :fast) AS overspeed_count
        FROM {telemetry}
        WHERE schema_version = 1 AND event_type = 'VEHICLE_TELEMETRY'
        GROUP BY vehicle_id""",
}


def run(name: str, telemetry: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    if name not in STATEMENTS:
        raise KeyError(f"no statement {name!r}; known: {', '.join(sorted(STATEMENTS))}")
    values = {"hot": limits.hot_engine_c, "low": limits.low_fuel_pct, "fast": limits.overspeed_kmh}
    text = STATEMENTS[name]
    used = {key: value for key, value in values.items() if f":{key}" in text}
    return telemetry.sparkSession.sql(text, args=used, telemetry=telemetry)
