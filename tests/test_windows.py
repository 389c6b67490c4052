import json
from datetime import timedelta

from pyspark.sql import functions as F

from cargolens.operators import telemetry as tm
from cargolens.streaming import fleet, slices, windows
from tests.test_streams import at, ordered, put, run, source
from tests.test_telemetry import BASE


def metrics(spark, tables):
    return {r["window_start"]: r for r in windows.read_metrics(spark, tables.windows).collect()}


def start(spark, tmp_path, *files, first=0):
    for i, rows in enumerate(files, first):
        put(tmp_path / "in", f"{i:03d}.json", rows)
    ordered(tmp_path / "in")
    tables = fleet.FleetTables(str(tmp_path / "out"))
    run(fleet.start(source(spark, tmp_path / "in"), tables, once=True, corrected=True))
    return tables


def admitted(spark, *rows):
    return tm.admit(fleet.telemetry_stream(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")))


def test_late_rows_are_kept_and_correct_their_window(spark, tmp_path):
    tables = start(spark, tmp_path, [at(0, speed=40.0), at(60, "VEH-102", speed=60.0)], [at(700)])
    before = metrics(spark, tables)
    assert [(r["avg_speed_kmh"], r["active_vehicle_count"]) for r in before.values()] == [(50.0, 2)]
    # A restart; the first window gets a third vehicle, the second one its first reading.
    tables = start(spark, tmp_path, [at(120, "VEH-103", speed=110.0), at(400, speed=10.0), at(720)], [at(1300)], first=2)
    after = metrics(spark, tables)
    first, second, third = (after[BASE + timedelta(minutes=m)] for m in (0, 5, 10))
    assert (first["avg_speed_kmh"], first["active_vehicle_count"], first["overspeed_vehicle_count"]) == (70.0, 3, 1)
    assert first["version"] > before[BASE]["version"]
    assert (second["avg_speed_kmh"], second["active_vehicle_count"]) == (10.0, 1)
    assert third["active_vehicle_count"] == 1 and len(after) == 3  # the window of the newest reading is open
    late = {r["event_id"]: r for r in windows.read_late(spark, tables.windows).collect()}
    assert set(late) == {"x120VEH-103", "x400VEH-101"}
    assert late["x120VEH-103"]["watermark"] == BASE + timedelta(seconds=690)
    assert late["x120VEH-103"]["lag_seconds"] == 570.0
    assert spark.read.parquet(tables.raw).count() == 7  # late readings stay in the history as well
    assert not slices.slice_names(spark, tables.held)


def test_any_order_of_files_gives_the_batch_result(spark, tmp_path):
    readings = [at(t, f"VEH-{t % 5:03d}", 60.0 + t % 90) for t in range(0, 7200, 41)]
    tables = start(spark, tmp_path, *[readings[k::4][::-1] for k in range(4)])
    batch = tm.fleet_metrics(fleet.telemetry_stream(spark.read.text(str(tmp_path / "in"))))
    closed = batch.filter(F.col("window_end") <= F.lit(BASE + timedelta(seconds=7175 - 10)))
    rows = lambda df: sorted((r["window_start"], r["active_vehicle_count"], round(r["avg_speed_kmh"], 9)) for r in df.collect())
    assert rows(windows.read_metrics(spark, tables.windows)) == rows(closed)
    assert windows.read_late(spark, tables.windows).count() > 100


def test_a_replayed_batch_publishes_the_same(spark, tmp_path):
    tables = windows.WindowTables(str(tmp_path))
    batches = [admitted(spark, at(0), at(900)), admitted(spark, at(30, speed=90.0), at(310)), admitted(spark, at(2000))]

    def contents():
        return [sorted(map(tuple, df.collect())) for df in (windows.read_metrics(spark, tables), windows.read_late(spark, tables))]

    for i, rows in enumerate(batches):
        windows.write_batch(rows, i, tables)
    before = contents()
    windows.write_batch(batches[2], 2, tables)
    windows.write_batch(batches[1], 1, tables)
    assert contents() == before and len(before[1]) == 2


def test_a_correction_reads_only_the_days_it_touches(spark, tmp_path, monkeypatch):
    tables = windows.WindowTables(str(tmp_path))
    windows.write_batch(admitted(spark, *[at(d * 86400) for d in range(9)]), 0, tables)
    read, write = [], slices.write_slice
    monkeypatch.setattr(slices, "write_slice", lambda df, path, b: (path.endswith("metrics") and read.extend(df.inputFiles()), write(df, path, b)))
    windows.write_batch(admitted(spark, at(3 * 86400 + 5)), 1, tables)
    days = {f"{BASE + timedelta(days=d):%Y%m%d}" for d in (3, 7)}
    assert {f.split("day=")[1][:8] for f in read} == days  # the touched day, and the one of the windows that may close


def test_empty_batches_and_rows_without_a_time(spark, tmp_path):
    tables = windows.WindowTables(str(tmp_path))
    windows.write_batch(admitted(spark, {}), 0, tables)
    windows.write_batch(admitted(spark, at(10) | {"event_timestamp": None}), 1, tables)
    assert windows.newest_before(spark, tables.progress, 5) is None
    assert windows.read_late(spark, tables).count() == 0
