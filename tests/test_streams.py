import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolens.operators import events as ev
from cargolens.operators import telemetry as tm
from cargolens.operators.parse import parse_delivery_events
from cargolens.streaming import delivery, fleet, slices, upkeep
from tests.test_telemetry import BASE, SCENARIO, SCHEMA

TELEMETRY = [part.split()[0] for part in SCHEMA.split(", ")]


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def telemetry(row, **change):
    document = dict(zip(TELEMETRY, row)) | change
    return {k: v.isoformat() + "Z" if isinstance(v, datetime) else v for k, v in document.items()}


def at(seconds, vehicle="VEH-101", speed=50.0):
    moment = BASE + timedelta(seconds=seconds)
    row = dict(zip(TELEMETRY, SCENARIO[0])) | {"event_id": f"x{seconds}{vehicle}", "vehicle_id": vehicle, "speed_kmh": speed}
    return telemetry(tuple((row | {"event_timestamp": moment, "ingestion_timestamp": moment}).values()))


def delivered(i, minute, delivery_id="d1", vehicle="v1", status="IN_TRANSIT", **change):
    return {
        "schema_version": 1, "event_id": f"e{i}", "event_type": status, "event_timestamp": f"2024-05-01T10:{minute:02d}:00Z",
        "delivery_id": delivery_id, "vehicle_id": vehicle, "source": "test",
        "payload": {"status": status, "latitude": 1, "longitude": 2, "capacity_used": 5, "capacity_total": 10, "delay_minutes": i},
    } | change


def source(spark, folder):
    """One file per micro-batch, in name order."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))


def run(queries):
    for query in queries:
        query.awaitTermination()


def ordered(folder):
    """The file source goes by modification time."""
    import os

    for i, path in enumerate(sorted(folder.iterdir())):
        os.utime(path, (1_700_000_000 + i * 10,) * 2)


def test_windows_close_with_the_watermark_and_late_rows_are_dropped(spark, tmp_path):
    put(tmp_path / "in", "1.json", [telemetry(r) for r in SCENARIO])
    ordered(tmp_path / "in")
    tables = fleet.FleetTables(str(tmp_path / "out"))
    run(fleet.start(source(spark, tmp_path / "in"), tables, once=True))
    # Watermark 00:08:50: only the first window is closed.
    rows = spark.read.parquet(tables.metrics).collect()
    assert [(r["window_start"], r["active_vehicle_count"], r["avg_speed_kmh"]) for r in rows] == [(BASE, 1, 85.0)]
    assert rows[0]["version"] == int((BASE - datetime(1970, 1, 1)).total_seconds()) * 1000

    put(tmp_path / "in", "2.json", [at(11 * 60)])  # moves the watermark past 00:10
    put(tmp_path / "in", "3.json", [at(12 * 60)])  # Spark judges lateness by the watermark before this batch
    put(tmp_path / "in", "4.json", [at(4 * 60, speed=170.0), at(9 * 60, speed=170.0)])  # both too late
    put(tmp_path / "in", "5.json", [at(30 * 60)])
    ordered(tmp_path / "in")
    run(fleet.start(source(spark, tmp_path / "in"), tables, once=True))
    rows = spark.read.parquet(tables.metrics).orderBy("window_start").collect()
    assert [(r["avg_speed_kmh"], r["overspeed_vehicle_count"]) for r in rows] == [(85.0, 1), (72.5, 0), (50.0, 0)]
    # The raw history and the alerts are stateless and keep the late readings.
    assert spark.read.parquet(tables.raw).count() == 9
    assert spark.read.parquet(tables.alerts).count() == 5
    assert fleet.read_state(spark, tables).select("event_id").first()[0] == "x1800VEH-101"


def test_closed_windows_equal_the_batch_result_over_many_files(spark, tmp_path):
    readings = [at(t, f"VEH-{t % 11:03d}", 60.0 + t % 90) for t in range(0, 3600, 7)]
    for i in range(0, len(readings), 100):
        put(tmp_path / "in", f"{i:05d}.json", readings[i : i + 100])
    ordered(tmp_path / "in")
    tables = fleet.FleetTables(str(tmp_path / "out"))
    run(fleet.start(source(spark, tmp_path / "in"), tables, once=True))
    streamed = spark.read.parquet(tables.metrics)
    batch = tm.fleet_metrics(fleet.telemetry_stream(spark.read.text(str(tmp_path / "in"))))
    closed = tm.versioned_metrics(batch).filter(F.col("window_end") <= F.lit(BASE + timedelta(seconds=3598 - 10)))
    assert closed.count() == 11
    assert sorted(map(tuple, streamed.select(closed.columns).collect())) == sorted(map(tuple, closed.collect()))


def test_unreadable_telemetry_goes_to_quarantine(spark, tmp_path):
    put(tmp_path / "in", "1.json", [telemetry(SCENARIO[0]), "{broken", telemetry(SCENARIO[1], event_type="HEARTBEAT")])
    tables = fleet.FleetTables(str(tmp_path / "out"))
    run(fleet.start(source(spark, tmp_path / "in"), tables, once=True))
    assert [r["value"] for r in spark.read.parquet(tables.quarantine).collect()] == ["{broken"]
    assert spark.read.parquet(tables.raw).count() == 1


@pytest.fixture
def delivery_run(spark, tmp_path):
    def start(*files, **options):
        for i, rows in enumerate(files):
            put(tmp_path / "in", f"{i}.json", rows)
        ordered(tmp_path / "in")
        tables = delivery.DeliveryTables(str(tmp_path / "out"))
        run(delivery.start(source(spark, tmp_path / "in"), tables, once=True, **options))
        return tables

    return start


def test_out_of_order_events_never_overwrite_newer_state(spark, delivery_run):
    tables = delivery_run(
        [delivered(1, 5), delivered(2, 30, status="DELIVERED")],
        [delivered(3, 10), delivered(4, 40, "d2", "v1")],
        ["{broken", delivered(5, 50, schema_version=2), delivered(6, 55, event_id=" ")],
    )
    state = {r["delivery_id"]: r for r in delivery.read_delivery_state(spark, tables).collect()}
    assert (state["d1"]["last_event_id"], state["d1"]["status"], state["d1"]["is_delayed"]) == ("e2", "DELIVERED", 1)
    assert state["d2"]["utilization_ratio"] == 0.5
    vehicles = delivery.read_vehicle_state(spark, tables).collect()
    assert [(r["vehicle_id"], r["delivery_id"]) for r in vehicles] == [("v1", "d2")]
    assert delivery.read_history(spark, tables).count() == 4
    assert spark.read.parquet(tables.quarantine).count() == 3


def test_repeated_ids_stay_in_the_history_unless_dedup_is_asked(spark, delivery_run, tmp_path):
    rows = [delivered(1, 5), delivered(1, 5), delivered(2, 6)]
    tables = delivery_run(rows, [delivered(1, 5)])
    assert delivery.read_history(spark, tables).count() == 4


def test_the_packed_history_holds_the_same_events(spark, delivery_run):
    tables = delivery_run([delivered(1, 5), delivered(2, 6)], [delivered(3, 7)])

    def shown():
        history = delivery.read_history(spark, tables)
        return history.schema["event_month"].dataType, sorted(str(r.asDict()) for r in history.select(sorted(history.columns)).collect())

    before = shown()
    assert len(before[1]) == 3
    delivery.maintain_history(spark, tables)
    upkeep.sweep(spark, tables.history)
    assert shown() == before
    delivery.maintain_history(spark, tables, before="999901")
    assert delivery.read_history(spark, tables).count() == 0


def test_dedup_drops_repeats_and_still_keeps_rejects(spark, delivery_run):
    tables = delivery_run([delivered(1, 5), delivered(1, 5), "{broken"], [delivered(1, 5), delivered(2, 6)], dedup=True)
    assert sorted(r["event_id"] for r in delivery.read_history(spark, tables).collect()) == ["e1", "e2"]
    assert spark.read.parquet(tables.quarantine).count() == 1


def batch_of(spark, *documents):
    return parse_delivery_events(spark.createDataFrame([(json.dumps(d),) for d in documents], "value string"))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    tables = delivery.DeliveryTables(str(tmp_path))
    first, second = batch_of(spark, delivered(1, 5), delivered(2, 9)), batch_of(spark, delivered(3, 7))
    delivery.write_batch(first, 0, tables)
    delivery.write_batch(second, 1, tables)

    def contents():
        return [
            sorted(map(tuple, frame.collect()))
            for frame in (
                delivery.read_history(spark, tables).select("event_id", "event_timestamp"),
                delivery.read_delivery_state(spark, tables),
                delivery.read_vehicle_state(spark, tables),
            )
        ]

    before = contents()
    delivery.write_batch(second, 1, tables)
    delivery.write_batch(first, 0, tables)
    assert contents() == before
    assert len(before[0]) == 3 and before[1][0][28] == "e2"


def test_a_batch_is_neither_held_on_executors_nor_moved_when_dealt(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*_):
        raise AssertionError("a micro-batch is persisted")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    tables = delivery.DeliveryTables(str(tmp_path))
    rows = batch_of(spark, *[delivered(i, 10 + i, f"d{i % 3}") for i in range(8)], delivered(8, 9, schema_version=2)).repartition(4)
    delivery.write_batch(rows, 0, tables, gather=False)
    files = {f.rsplit("/", 1)[1][:10] for f in delivery.read_history(spark, tables).inputFiles()}
    assert len(files) > 1  # each task wrote its own rows
    assert delivery.read_history(spark, tables).count() == 8
    assert [r["event_id"] for r in spark.read.parquet(tables.quarantine).collect()] == ["e8"]
    assert sorted(r["last_event_id"] for r in delivery.read_delivery_state(spark, tables).collect()) == ["e5", "e6", "e7"]
    # A batch without rows or without admitted rows leaves readable tables.
    delivery.write_batch(rows.limit(0), 1, tables, gather=False)
    delivery.write_batch(batch_of(spark, delivered(9, 9, schema_version=2)), 2, tables)
    assert (delivery.read_history(spark, tables).count(), spark.read.parquet(tables.quarantine).count()) == (8, 2)


def test_the_dealt_event_stream_holds_every_event(spark, sf_dir, monkeypatch):
    from cargolens.sources import adapters
    from cargolens.streaming.run import drain

    monkeypatch.setattr(adapters, "EVENTS_PER_TASK", 5_000)
    dealt, whole = drain(spark, adapters.delivery_event_stream(spark, sf_dir), "dealt-test"), adapters.delivery_events(spark, sf_dir)
    assert sorted(dealt.columns) == sorted(whole.columns)
    assert dealt.select(whole.columns).exceptAll(whole).isEmpty() and dealt.count() == whole.count()


def test_the_event_stream_holds_no_shuffle(spark, sf_dir, tmp_path):
    from cargolens.sources import adapters

    stream = adapters.delivery_event_stream(spark, sf_dir, f"{tmp_path}/arriving")
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Repartition" not in plan and "orders" not in plan and "LeftOuter" not in plan
    dealt = spark.read.parquet(f"{tmp_path}/arriving")
    assert dealt.count() == adapters.table(spark, sf_dir, "lineitem").count()
    assert not {"l_tax", "l_discount"} & set(dealt.columns)  # no event holds them
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with adapters.file_per_task(spark):
        assert spark.read.parquet(f"{tmp_path}/arriving").rdd.getNumPartitions() == len(dealt.inputFiles())
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_a_slice_is_written_in_passes_over_shares_of_its_keys(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"k{k % 7}" if k % 8 else None, k, f"n{k}") for k in range(50)], "k string, version int, note string")
    want = sorted(map(str, slices.latest_by_key(rows, ["k"], ["version"]).collect()))
    asked, latest, freed = [], slices.latest_by_key, []
    monkeypatch.setattr(slices, "PASS_ROWS", 12)
    monkeypatch.setattr(slices, "latest_by_key", lambda df, *a: (asked.append(df.count()), latest(df, *a))[1])
    monkeypatch.setattr(slices, "free_shuffles", freed.append)
    for _ in range(2):  # a replay replaces what is there
        slices.write_latest_slice(rows, f"{tmp_path}/state", 3, ["k"], ["version"])
        assert slices.slice_names(spark, f"{tmp_path}/state") == [slices.delta(3)]
        assert sorted(map(str, spark.read.parquet(f"{tmp_path}/state").drop("slice").collect())) == want
    assert len(asked) == 10 and sum(asked) == 100 and max(asked) < 50 and len(freed) == 10
    slices.write_latest_slice(rows.limit(0), f"{tmp_path}/state", 4, ["k"], ["version"])
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/state").drop("slice").collect())) == want


def test_compaction_keeps_the_latest_state_at_every_step(spark, tmp_path):
    tables = delivery.DeliveryTables(str(tmp_path))
    for i in range(4):
        delivery.write_batch(batch_of(spark, delivered(i, 10 - i, f"d{i % 2}")), i, tables)
    keys, order = ["delivery_id"], ev.DELIVERY_STATE_ORDER

    def state():
        return sorted(map(tuple, delivery.read_delivery_state(spark, tables).collect()))

    before = state()
    removed = slices.compact(spark, tables.deliveries, keys, order, up_to=2, partitions=2)
    assert removed == [f"slice=delta-{i:012d}" for i in range(3)]
    assert state() == before
    # A run that stopped after the base was written: the leftovers are harmless, and a rerun removes them.
    delivery.write_batch(batch_of(spark, delivered(0, 10, "d0")), 0, tables)
    assert state() == before
    assert slices.compact(spark, tables.deliveries, keys, order, up_to=2) == ["slice=delta-000000000000"]
    assert slices.compact(spark, tables.deliveries, keys, order, up_to=3) == ["slice=base-000000000002", "slice=delta-000000000003"]
    assert state() == before
    assert slices.slice_names(spark, tables.deliveries) == ["slice=base-000000000003"]


def test_application_metadata_drives_the_stream(spark, tmp_path):
    from pathlib import Path

    from cargolens.plans.streams import start_application
    from cargolens.sources.metadata import Application

    folder = Path(__file__).resolve().parents[1] / "applications"
    app = Application.load(folder / "fleet.yaml")
    assert (app.topic, app.database) == ("vehicle-telemetry-events", "fleet")
    assert tm.AlertLimits.of(app.processing) == tm.AlertLimits()
    put(tmp_path / "in", "1.json", [telemetry(r) for r in SCENARIO])
    run(start_application(spark, app, str(tmp_path / "out"), values=source(spark, tmp_path / "in"), once=True))
    assert spark.read.parquet(fleet.FleetTables(str(tmp_path / "out")).alerts).count() == 3
    assert Application.load(folder / "delivery.yaml").datasets == ("delivery.transportation_costs",)
    with pytest.raises(ValueError, match="no stream for application"):
        start_application(spark, Application("x", "y", None), "z", values=spark.range(1))
    with pytest.raises(ValueError, match="no streaming topic"):
        start_application(spark, Application("x", "y", None), "z")


def test_late_rows_are_counted(spark, tmp_path):
    from cargolens.streaming.run import late_rows

    for i, rows in enumerate(([at(0)], [at(3600)], [at(3601)], [at(5), at(6)])):
        put(tmp_path / "in", f"{i}.json", rows)
    ordered(tmp_path / "in")
    windows = fleet.window_metrics(fleet.telemetry_stream(source(spark, tmp_path / "in")))
    query = (
        windows.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    # Both late rows share a window and a vehicle: they are dropped as one partial group.
    assert late_rows(query) == 1


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_dedup_drops_every_copy(spark, tmp_path, salts):
    from cargolens.streaming.run import dedup, drain

    copies = [at(1)] * 50
    for i, rows in enumerate(([*copies, at(2)], [*copies, at(3)], copies)):
        put(tmp_path / "in", f"{i}.json", rows)
    ordered(tmp_path / "in")
    marked = fleet.watermarked(fleet.telemetry_stream(source(spark, tmp_path / "in")))
    rows = drain(spark, dedup(marked, "event_id", salts), "dedup-test").collect()
    assert sorted(r["event_id"] for r in rows) == ["x1VEH-101", "x2VEH-101", "x3VEH-101"]
