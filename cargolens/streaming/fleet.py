"""Fleet telemetry stream: raw history, latest state, alerts and window metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolens.operators import telemetry as tm
from cargolens.operators.latest import latest_by_key
from cargolens.operators.parse import parse_telemetry
from cargolens.sources.tables import SORT_KEYS
from cargolens.streaming import windows
from cargolens.streaming.run import spread
from cargolens.streaming.slices import hold, read_latest, release, write_month_slice, write_slice

WATERMARK = "10 seconds"
CHECKPOINT_EVERY = "10 seconds"


@dataclass(frozen=True)
class FleetTables:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/vehicle_telemetry_events"

    @property
    def state(self) -> str:
        return f"{self.root}/vehicle_current_state"

    @property
    def alerts(self) -> str:
        return f"{self.root}/vehicle_health_alerts"

    @property
    def metrics(self) -> str:
        return f"{self.root}/vehicle_metrics_5m"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def held(self) -> str:
        return f"{self.root}/_held"

    @property
    def windows(self) -> windows.WindowTables:
        return windows.WindowTables(f"{self.root}/vehicle_windows")

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoint/{query}"


def telemetry_stream(values: DataFrame) -> DataFrame:
    """Typed telemetry; unreadable rows are skipped here and kept by ``write_batch``."""
    return parse_telemetry(values).filter(~F.col("is_corrupt")).drop("value", "is_corrupt")


def watermarked(telemetry: DataFrame) -> DataFrame:
    typed = telemetry.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return typed.withWatermark("event_timestamp", WATERMARK)


def window_metrics(telemetry: DataFrame, limits: tm.AlertLimits = tm.AlertLimits()) -> DataFrame:
    """Closed five-minute windows of a telemetry stream; late rows are dropped."""
    return tm.fleet_metrics_stream(tm.admit(watermarked(telemetry)), limits)


def write_batch(parsed: DataFrame, batch_id: int, tables: FleetTables, limits: tm.AlertLimits, corrected: bool = False) -> None:
    """The outputs of one micro-batch, which is parsed once and read back from the shared folder by each of them."""
    held = hold(parsed, tables.held, batch_id)
    write_slice(held.filter("is_corrupt").select("value"), tables.quarantine, batch_id)
    admitted = tm.admit(held.filter(~F.col("is_corrupt")).drop("value", "is_corrupt"))
    write_month_slice(tm.raw(admitted), tables.raw, batch_id, "event_timestamp", SORT_KEYS["vehicle_telemetry_events"])
    state = latest_by_key(tm.state_projection(admitted), ["vehicle_id"], tm.FLEET_STATE_ORDER)
    write_slice(state, tables.state, batch_id)
    alerts = tm.health_alerts(admitted, limits)
    write_month_slice(alerts, tables.alerts, batch_id, "event_timestamp", SORT_KEYS["vehicle_health_alerts"])
    if corrected:
        windows.write_batch(admitted, batch_id, tables.windows, limits)
    release(parsed.sparkSession, tables.held, batch_id)


def start(
    values: DataFrame,
    tables: FleetTables,
    limits: tm.AlertLimits = tm.AlertLimits(),
    *,
    once: bool = False,
    tasks: int | None = None,
    corrected: bool = False,
) -> list[StreamingQuery]:
    """Two queries over the source: the stateless outputs together, the windows apart.

    With ``corrected`` one query reads the source and writes all outputs: late readings are kept in a side table and
    correct the windows they belong to (``windows``), where the watermark of the other query drops them.
    """
    values = spread(values, tasks)
    serving = (
        parse_telemetry(values)
        .writeStream.queryName("fleet-serving")
        .option("checkpointLocation", tables.checkpoint("serving"))
        .foreachBatch(lambda df, batch_id: write_batch(df, batch_id, tables, limits, corrected))
    )
    trigger = {"availableNow": True} if once else {"processingTime": CHECKPOINT_EVERY}
    if corrected:
        return [serving.trigger(**trigger).start()]
    metrics = (
        tm.versioned_metrics(window_metrics(telemetry_stream(values), limits))
        .writeStream.queryName("fleet-metrics")
        .format("parquet")
        .outputMode("append")
        .option("path", tables.metrics)
        .option("checkpointLocation", tables.checkpoint("metrics"))
    )
    return [serving.trigger(**trigger).start(), metrics.trigger(**trigger).start()]


def read_state(spark: SparkSession, tables: FleetTables) -> DataFrame:
    return read_latest(spark, tables.state, ["vehicle_id"], tm.FLEET_STATE_ORDER)
