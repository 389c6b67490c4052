"""Queries over tables that are kept up to date: by streams that take late and repeated rows, and from change feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.functions.times import month_key
from cargolens.operators import changes, costs, distinct, lateness, trends
from cargolens.operators import events as ev
from cargolens.operators import telemetry as tm
from cargolens.operators.latest import latest_by_key
from cargolens.operators.parse import telemetry_json
from cargolens.plans.incremental import Layer, refresh
from cargolens.session import free_shuffles, shared_dir
from cargolens.sources import adapters
from cargolens.sources.tables import SORT_KEYS
from cargolens.streaming import fleet, keyed, seen, slices, upkeep, windows

PARTS = 3
COST_KEY, COST_ORDER = ["cost_id"], ["updated_at", "vehicle_id", "route_id"]
ROUTE_LIMIT_KM, LATE_SECONDS = 2.0, 30


def _telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.view(spark, sf, "vehicle_telemetry")


# -- streams -----------------------------------------------------------------------


def arriving(parts: list[DataFrame], root: str, start: Callable[[DataFrame], list]) -> None:
    """Hand the parts to a stream one after the other; it is stopped and started again for each, and the part it has committed is removed."""
    spark, folder = parts[0].sparkSession, f"{root}/arriving"
    for k, part in enumerate(parts):
        part.write.parquet(f"{folder}/{k}", compression="zstd")
        free_shuffles(spark)
        stream = spark.readStream.schema(part.schema).option("recursiveFileLookup", "true").parquet(folder)
        done = [query.awaitTermination() for query in start(stream)]  # no name is left for a query, which holds its shuffle files
        assert done
        slices.remove(spark, f"{folder}/{k}")
        free_shuffles(spark)


def _corrected(spark: SparkSession, sf: str) -> windows.WindowTables:
    """Each part spans the whole time, so all but the first bring mostly late readings."""
    tables = fleet.FleetTables(shared_dir(spark, "late"))
    rows = _telemetry(spark, sf)
    parts = [telemetry_json(rows.where(F.col("event_id").cast("long") % PARTS == k)) for k in range(PARTS)]
    arriving(parts, tables.root, lambda stream: fleet.start(stream, tables, once=True, corrected=True))
    return tables.windows


def fleet_metrics_corrected_stream(spark: SparkSession, sf: str) -> DataFrame:
    return windows.read_metrics(spark, _corrected(spark, sf)).drop("version")


def late_telemetry_stream(spark: SparkSession, sf: str) -> DataFrame:
    return windows.read_late(spark, _corrected(spark, sf))


def delivery_state_keyed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery state held by the stream; older versions keep coming in later parts."""
    root = shared_dir(spark, "keyed")
    rows = ev.delivery_projection(adapters.delivery_events(spark, sf))
    part = F.pmod(F.xxhash64("last_event_id", "vehicle_id"), F.lit(PARTS))

    def start(stream: DataFrame) -> list:
        with keyed.rocksdb(spark):
            latest = keyed.latest(stream, ["delivery_id"], ev.DELIVERY_STATE_ORDER)
            writer = latest.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
            return [writer.foreachBatch(lambda df, _: df.write.format("noop").mode("overwrite").save()).trigger(availableNow=True).start()]

    arriving([rows.where(part == k) for k in range(PARTS)], root, start)
    return keyed.snapshot(spark, f"{root}/checkpoint", rows.schema)


def telemetry_dedup_history_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh reading comes again a month later, every eleventh after two months and again as it was."""
    tables = seen.SeenTables(shared_dir(spark, "seen"))
    rows = tm.raw(tm.admit(_telemetry(spark, sf))).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    number, time = F.col("event_id").cast("long"), F.col("event_timestamp")
    later = lambda every, days: rows.where(number % every == 0).withColumn("event_timestamp", time + F.expr(f"INTERVAL '{days}' DAY"))
    parts = [rows.where(number % 3 != 0), rows.unionByName(later(7, 31)), later(11, 62).unionByName(rows.where(number % 11 == 0))]
    sort = SORT_KEYS["vehicle_telemetry_events"]

    def start(stream: DataFrame) -> list:
        writer = stream.writeStream.option("checkpointLocation", tables.checkpoint)
        return [writer.foreachBatch(lambda df, b: seen.write_batch(df, b, tables, "event_id", "event_timestamp", sort=sort)).trigger(availableNow=True).start()]

    arriving(parts, tables.root, start)
    return seen.read_history(spark, tables)


def telemetry_history_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of four months taken in three batches; packed and expired after the second, packed again and swept after the third."""
    root, sort = shared_dir(spark, "kept"), SORT_KEYS["vehicle_telemetry_events"]
    path, checkpoint = f"{root}/history", f"{root}/checkpoint"
    rows = tm.raw(tm.admit(_telemetry(spark, sf))).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    number = F.col("event_id").cast("long")
    first = rows.agg(F.min("event_timestamp")).head()[0]
    moved = rows.withColumn("event_timestamp", F.add_months(F.lit(first).cast("date"), number.cast("int") % 4).cast("timestamp"))
    parts = [moved.where(F.pmod(F.xxhash64("event_id"), F.lit(PARTS)) == k) for k in range(PARTS)]
    done = []

    def start(stream: DataFrame) -> list:
        writer = stream.writeStream.option("checkpointLocation", checkpoint)
        query = writer.foreachBatch(lambda df, b: slices.write_month_slice(df, path, b, "event_timestamp", sort)).trigger(availableNow=True).start()
        query.awaitTermination()
        done.append(query)
        if len(done) > 1 and first:
            before = F.date_format(F.add_months(F.lit(first).cast("date"), 1), "yyyyMM")
            upkeep.maintain(spark, path, upkeep.committed(spark, checkpoint), rows.schema, sort, before=spark.range(1).select(before).head()[0])
        return [query]

    arriving(parts, root, start)
    upkeep.sweep(spark, path)
    return upkeep.read(spark, path, rows.schema)


# -- change feeds -------------------------------------------------------------------


def _revised(rows: DataFrame) -> DataFrame:
    """A later version of the cost table: of the last year some rows are gone, some moved, some corrected, some new."""
    recent = F.col("business_date") >= F.lit("1998-01-01").cast("date")
    kind = F.when(recent, F.col("delivery_count") % 7).otherwise(F.lit(-1))
    moved, corrected = kind == 1, kind == 2
    more = lambda c, amount: F.when(moved | corrected, F.col(c) + F.lit(amount)).otherwise(F.col(c)).cast("decimal(12,2)")
    changed = rows.where(kind != 0).withColumns(
        {
            "business_date": F.when(moved, F.date_add("business_date", 40)).otherwise(F.col("business_date")),
            "route_id": F.when(moved, F.concat("route_id", F.lit("-b"))).otherwise(F.col("route_id")),
            "other_cost": more("other_cost", 2),
            "actual_total_cost": more("actual_total_cost", 2),
        }
    )
    # The new rows alone are dealt by their new key; the others stay where they are.
    return changed.unionByName(rows.where(kind == 3).withColumn("cost_id", F.concat(F.lit("extra-"), "cost_id")).repartition("cost_id"))


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", month_key(F.col("business_date")).cast("int"))


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = latest_by_key(adapters.view(spark, sf, "transportation_costs"), COST_KEY, COST_ORDER)
    return rows, _revised(rows)


def cost_change_feed(spark: SparkSession, sf: str) -> DataFrame:
    return changes.change_feed(*_versions(spark, sf), COST_KEY)


def cost_feed_applied(spark: SparkSession, sf: str) -> DataFrame:
    """The old version after the feed: the new one."""
    old, new = _versions(spark, sf)
    return changes.apply_feed(old, changes.change_feed(old, new, COST_KEY), COST_KEY)


def _gold(rows: DataFrame) -> DataFrame:
    return _with_month(costs.gold(costs.silver(rows)))


def cost_gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Gold of the old version, brought up to date from the feed: only the months it touches are read and replaced."""
    root = shared_dir(spark, "incremental")
    current = lambda rows: latest_by_key(rows, COST_KEY, COST_ORDER)
    detail, gold = Layer(f"{root}/costs", "month"), Layer(f"{root}/gold", "month")
    taken = f"{root}/taken"  # written once more, so that only one shuffle of whole rows is there at a time
    current(adapters.view(spark, sf, "transportation_costs")).write.parquet(taken, compression="zstd")
    free_shuffles(spark)
    detail.create(_with_month(spark.read.parquet(taken)))
    slices.remove(spark, taken)
    gold.create(_gold(detail.read(spark)))
    # Both versions come from one shuffle of the table by its key.
    old = current(detail.read(spark).drop("month"))
    feed = changes.change_feed(_with_month(old), _with_month(_revised(old)), COST_KEY)
    feed.write.parquet(f"{root}/feed", compression="zstd")
    free_shuffles(spark)
    feed = spark.read.schema(feed.schema).parquet(f"{root}/feed")
    refresh(spark, feed, detail, gold, keys=COST_KEY, groups=[*ev.ROUTE_KEYS, "month"], build=_gold)
    return gold.read(spark).drop("month")


# -- lateness and routes -------------------------------------------------------------


def _taken_in() -> Column:
    """When a reading was taken in: some are held up for seconds, some for minutes."""
    number = F.col("event_id").cast("long")
    wait = F.when(number % 97 == 0, 600).when(number % 13 == 0, 45).otherwise(0)
    return F.col("ingestion_timestamp") + F.make_dt_interval(secs=wait.cast("decimal(18,6)"))


def late_telemetry_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    rows = _telemetry(spark, sf).select("event_timestamp", _taken_in().alias("taken_at"), F.col("event_id").cast("long").alias("event_id"))
    return lateness.late_by_hour(lateness.lateness(rows, ["taken_at", "event_id"]), LATE_SECONDS)


def route_deviation(spark: SparkSession, sf: str) -> DataFrame:
    positions = adapters.delivery_events(spark, sf, ["event_id", "delivery_id", "vehicle_id", "event_timestamp", "latitude", "longitude"])
    return trends.route_deviation(positions, adapters.view(spark, sf, "planned_stops"), ROUTE_LIMIT_KM)


def active_vehicles_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bitmaps written by two runs, then vehicles per day, week and month from these alone."""
    root, keys = shared_dir(spark, "active"), ["vehicle_status"]
    rows = tm.admit(_telemetry(spark, sf)).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    number = F.regexp_extract("vehicle_id", "^VEH-([0-9]{3})$", 1).try_cast("int")
    for run in range(2):
        part = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == run)
        distinct.partials(part, keys, "event_timestamp", number).write.parquet(f"{root}/run={run}")
    stored = distinct.merged(spark.read.parquet(root), keys)
    found = [distinct.counts(stored, keys, g, "active_vehicle_count").select(F.lit(g).alias("grain"), "*") for g in ("day", "week", "month")]
    return found[0].unionByName(found[1]).unionByName(found[2])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fleet_metrics_corrected_stream": fleet_metrics_corrected_stream,
    "late_telemetry_stream": late_telemetry_stream,
    "delivery_state_keyed_stream": delivery_state_keyed_stream,
    "telemetry_dedup_history_stream": telemetry_dedup_history_stream,
    "telemetry_history_kept": telemetry_history_kept,
    "cost_change_feed": cost_change_feed,
    "cost_feed_applied": cost_feed_applied,
    "cost_gold_incremental": cost_gold_incremental,
    "late_telemetry_by_hour": late_telemetry_by_hour,
    "route_deviation": route_deviation,
    "active_vehicles_by_period": active_vehicles_by_period,
}
