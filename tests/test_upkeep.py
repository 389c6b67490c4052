from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import types as T

from cargolens.streaming import slices, upkeep

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("time", T.TimestampType()), T.StructField("note", T.StringType())])


def batch(number):
    rows = [(number * 100 + k, datetime(2024, 1 + k % 3, 2, k), f"n{k}") for k in range(12)]
    return [*rows, (number, None, None), (number * 100, datetime(2024, 1, 2), "n0")]


def add(spark, path, *numbers):
    for number in numbers:
        slices.write_month_slice(spark.createDataFrame(batch(number), SCHEMA).repartition(3), path, number, "time", ["id"])


def rows_of(spark, path, **options):
    return sorted(map(str, upkeep.read(spark, path, SCHEMA, **options).drop("event_month").collect()))


def plain(*numbers, first_month=1):
    rows = [T.Row(id=r[0], time=r[1], note=r[2]) for n in numbers for r in batch(n)]
    return sorted(str(r) for r in rows if r["time"] is None or r["time"].month >= first_month)


def files(spark, path):
    return [f for month in upkeep.months(spark, path) for f in upkeep.live(spark, path, month)]


def test_packing_keeps_the_rows_and_newer_batches(spark, tmp_path):
    path = str(tmp_path / "h")
    assert upkeep.read(spark, path, SCHEMA).count() == 0 and upkeep.maintain(spark, path, 9, SCHEMA, ["id"]) == 0
    add(spark, path, 0, 1, 2)
    before = files(spark, path)
    assert rows_of(spark, path) == plain(0, 1, 2)
    fewer = upkeep.maintain(spark, path, 1, SCHEMA, ["id"])  # batch 2 is not committed yet
    assert fewer > 0 and len(files(spark, path)) == len(before) - fewer
    assert rows_of(spark, path) == plain(0, 1, 2)
    add(spark, path, 1, 3)  # a replay of a packed batch, and a new one
    assert rows_of(spark, path) == plain(0, 1, 2, 3)
    upkeep.maintain(spark, path, 3, SCHEMA, ["id"])
    assert upkeep.sweep(spark, path) > 0 and upkeep.sweep(spark, path) == 0
    assert rows_of(spark, path) == plain(0, 1, 2, 3) and len(files(spark, path)) == 4
    assert rows_of(spark, path, only=["202401"]) == [r for r in plain(0, 1, 2, 3) if "2024, 1," in r]


def test_every_step_may_stop(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    add(spark, path, 0, 1)
    commit = upkeep._commit

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(upkeep, "_commit", stop)  # packed files are written, no manifest names them
    with pytest.raises(RuntimeError, match="stopped"):
        upkeep.maintain(spark, path, 1, SCHEMA, ["id"])
    assert rows_of(spark, path) == plain(0, 1)
    monkeypatch.setattr(upkeep, "_commit", commit)
    upkeep.maintain(spark, path, 1, SCHEMA, ["id"])
    assert rows_of(spark, path) == plain(0, 1)
    with pytest.raises(RuntimeError, match="someone else"):
        upkeep._commit(spark, path, "202401", 1, {})
    upkeep.sweep(spark, path)
    assert rows_of(spark, path) == plain(0, 1)


def test_months_expire_and_stay_expired(spark, tmp_path):
    path = str(tmp_path / "h")
    add(spark, path, 0, 1)
    assert upkeep.expire(spark, path, "202402") == ["202401"] and upkeep.expire(spark, path, "202402") == []
    assert rows_of(spark, path) == plain(0, 1, first_month=2)
    upkeep.sweep(spark, path)
    assert "202401" not in slices.folder_values(spark, path, "event_month") or not upkeep._batches(spark, path, "202401", -1)
    add(spark, path, 2)  # rows that come late for the month
    upkeep.maintain(spark, path, 2, SCHEMA, ["id"])
    assert rows_of(spark, path) == plain(0, 1, 2, first_month=2)


def test_files_are_dealt_by_size(spark, tmp_path):
    assert upkeep.bins([("a", 6), ("b", 5), ("c", 4), ("d", 3), ("e", 11)], 10) == [["e"], ["a", "c"], ["b", "d"]]
    path = str(tmp_path / "h")
    add(spark, path, 0, 1, 2)
    upkeep.maintain(spark, path, 2, SCHEMA, ["id"], target=4000)
    assert rows_of(spark, path) == plain(0, 1, 2)
    assert all(size <= 8000 for m in upkeep.months(spark, path) for n, _ in upkeep._list(spark, f"{path}/_packed/event_month={m}")
               for _, size in upkeep._data(spark, path, f"_packed/event_month={m}/{n}"))
