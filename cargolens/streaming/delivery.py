"""Delivery stream: JSON values to event history, delivery state and vehicle state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolens.operators import events as ev
from cargolens.operators.parse import is_valid_delivery, parse_delivery_events
from cargolens.session import free_shuffles
from cargolens.sources.tables import SORT_KEYS
from cargolens.streaming import upkeep
from cargolens.streaming.run import dedup as drop_repeats
from cargolens.streaming.run import spread
from cargolens.streaming.slices import has_month_slice, read_latest, read_month_slice, write_latest_slice, write_month_slice, write_slice

WATERMARK = "30 seconds"
CHECKPOINT_EVERY = "10 seconds"


@dataclass(frozen=True)
class DeliveryTables:
    """Folders the stream writes; all below one shared root."""

    root: str

    @property
    def history(self) -> str:
        return f"{self.root}/delivery_events"

    @property
    def deliveries(self) -> str:
        return f"{self.root}/delivery_current_state"

    @property
    def vehicles(self) -> str:
        return f"{self.root}/vehicle_current_state"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def valid_events(values: DataFrame, *, dedup: bool = False) -> DataFrame:
    """Parsed, admitted and watermarked events of a stream of JSON values.

    With ``dedup`` an event id seen before within the watermark is dropped; without,
    repeated events reach the history as they do in the reference.
    """
    parsed = parse_delivery_events(values).filter(is_valid_delivery()).drop("is_corrupt")
    marked = parsed.withWatermark("event_timestamp", WATERMARK)
    return drop_repeats(marked, "event_id") if dedup else marked


def rejected_delivery() -> Column:
    return ~F.coalesce(is_valid_delivery(), F.lit(False))


def write_quarantine(rejected: DataFrame, batch_id: int, tables: DeliveryTables) -> None:
    write_slice(rejected.select("raw_event", "is_corrupt", "schema_version", "event_id"), tables.quarantine, batch_id)


def write_serving(good: DataFrame, batch_id: int, tables: DeliveryTables, gather: bool = True) -> None:
    """Admitted events into history first, then both states, which read the columns they use from there.

    The shuffle files of each step go before the next.
    """
    write_month_slice(good, tables.history, batch_id, "event_timestamp", SORT_KEYS["delivery_events"], gather)
    free_shuffles(good.sparkSession)
    written = read_month_slice(good.sparkSession, tables.history, batch_id, good.schema)
    write_latest_slice(ev.delivery_projection(written), tables.deliveries, batch_id, ["delivery_id"], ev.DELIVERY_STATE_ORDER)
    write_latest_slice(ev.vehicle_projection(written), tables.vehicles, batch_id, ["vehicle_id"], ev.VEHICLE_STATE_ORDER)


def write_batch(rows: DataFrame, batch_id: int, tables: DeliveryTables, gather: bool = True) -> None:
    """One micro-batch into quarantine and serving tables; nothing of it is held on executors.

    The rows are parsed on their way into the history, which counts the rejected ones; only a batch that has some is parsed again
    for the quarantine. Every write replaces what an earlier attempt at the same batch left behind.
    """
    if "is_corrupt" not in rows.columns:
        write_serving(rows, batch_id, tables, gather)
        return
    seen = Observation()
    counted = rows.observe(seen, F.count_if(rejected_delivery()).alias("rejected"))
    write_serving(counted.filter(is_valid_delivery()).drop("is_corrupt"), batch_id, tables, gather)
    spark = rows.sparkSession
    # Without admitted rows the count may be gone from the plan: then all rows are looked at.
    some = not has_month_slice(spark, tables.history, batch_id) or seen.get["rejected"]
    write_quarantine(rows.filter(rejected_delivery()) if some else spark.createDataFrame([], rows.schema), batch_id, tables)


def start(
    values: DataFrame, tables: DeliveryTables, *, dedup: bool = False, once: bool = False, tasks: int | None = None, gather: bool = True
) -> list[StreamingQuery]:
    """Start the stream; ``once`` drains what is there and stops.

    With ``dedup`` the serving query keeps event-id state, which inadmissible rows
    cannot enter; a second query takes those to the quarantine. ``tasks`` spreads a
    source of few partitions. Without ``gather`` the history is written where events are parsed (``write_month_slice``).
    """
    values = spread(values, tasks)
    trigger = {"availableNow": True} if once else {"processingTime": CHECKPOINT_EVERY}

    def run(stream: DataFrame, name: str, write) -> StreamingQuery:
        writer = stream.writeStream.queryName(name).option("checkpointLocation", f"{tables.checkpoint}/{name}")
        return writer.foreachBatch(write).trigger(**trigger).start()

    parsed = parse_delivery_events(values)
    if not dedup:
        return [run(parsed, "delivery-serving", lambda df, batch_id: write_batch(df, batch_id, tables, gather))]
    rejected = parsed.filter(rejected_delivery())
    return [
        run(valid_events(values, dedup=True), "delivery-serving", lambda df, batch_id: write_batch(df, batch_id, tables, gather)),
        run(rejected, "delivery-quarantine", lambda df, batch_id: write_quarantine(df, batch_id, tables)),
    ]


def read_delivery_state(spark: SparkSession, tables: DeliveryTables) -> DataFrame:
    return read_latest(spark, tables.deliveries, ["delivery_id"], ev.DELIVERY_STATE_ORDER)


def read_vehicle_state(spark: SparkSession, tables: DeliveryTables) -> DataFrame:
    return read_latest(spark, tables.vehicles, ["vehicle_id"], ev.VEHICLE_STATE_ORDER).drop("_event_id")


def read_history(spark: SparkSession, tables: DeliveryTables) -> DataFrame:
    if not upkeep.maintained(spark, tables.history):
        return spark.read.parquet(tables.history).drop("batch")
    return upkeep.read(spark, tables.history).withColumn("event_month", F.expr("try_cast(event_month AS int)"))


def maintain_history(spark: SparkSession, tables: DeliveryTables, before: str | None = None, target: int = upkeep.TARGET) -> int:
    """Pack the history of committed batches and expire months before ``before`` (yyyyMM); returns how many fewer files are read."""
    up_to = upkeep.committed(spark, f"{tables.checkpoint}/delivery-serving")
    return upkeep.maintain(spark, tables.history, up_to, None, SORT_KEYS["delivery_events"], before, target)
