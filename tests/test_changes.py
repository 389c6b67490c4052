from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolens.operators import changes, lateness, trends
from cargolens.plans.incremental import Layer, refresh

SCHEMA = "id string, month string, region string, cost double, note string"
OLD = [("a", "01", "x", 1.0, None), ("b", "01", "x", 2.0, "n"), ("c", "02", "y", 3.0, "n"), ("d", "02", "y", float("nan"), "n"), ("e", "03", "z", 5.0, "n"), ("f", "04", "w", 6.0, "n"), (None, "04", "w", 7.0, "null key"), ("g", "05", "v", 8.0, "n")]
NEW = [("a", "01", "x", 1.0, None), ("b", "02", "y", 2.0, "moved"), ("c", "02", "y", 3.5, "n"), ("d", "02", "y", float("nan"), "n"), ("f", "04", "w", 6.0, None), (None, "04", "w", 7.5, "null key"), ("g", "05", "v", 8.0, "n"), ("h", "06", "u", 9.0, "new")]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)


def test_feed_holds_both_images_of_what_changed(versions):
    feed = changes.change_feed(*versions, ["id"])
    assert sorted((r["change"], str(r["id"])) for r in feed.collect()) == sorted(
        [(k, i) for i in ("b", "c", "f", "None") for k in ("update_before", "update_after")] + [("delete", "e"), ("insert", "h")]
    )
    assert sorted(str(r["id"]) for r in changes.after_images(feed).collect()) == ["None", "b", "c", "f", "h"]


def test_applying_a_feed_gives_the_new_version_also_twice(versions):
    old, new = versions
    feed = changes.change_feed(old, new, ["id"])
    once = changes.apply_feed(old, feed, ["id"])
    assert rows(once) == rows(new) == rows(changes.apply_feed(once, feed, ["id"]))
    assert changes.change_feed(old, old, ["id"]).isEmpty()
    assert rows(changes.apply_feed(old, changes.change_feed(old, old.where("false"), ["id"]), ["id"])) == []
    with pytest.raises(ValueError, match="columns"):
        changes.change_feed(old, new.drop("note"), ["id"])


def total(detail):
    return detail.groupBy("month", "region").agg(F.sum(F.nanvl("cost", F.lit(0.0))).alias("cost"), F.count("*").alias("n"))


def test_refresh_equals_a_full_run_and_reads_touched_partitions_only(spark, tmp_path, versions, monkeypatch):
    old, new = versions
    detail, result = Layer(f"{tmp_path}/detail", "month"), Layer(f"{tmp_path}/result", "month")
    detail.create(old)
    result.create(total(old))
    feed = changes.change_feed(old, new, ["id"])
    feed.write.parquet(f"{tmp_path}/feed")
    feed = spark.read.schema(feed.schema).parquet(f"{tmp_path}/feed")
    read, replace = [], Layer.replace
    monkeypatch.setattr(Layer, "replace", lambda self, df, values: (read.extend(df.inputFiles()), replace(self, df, values))[1])
    assert refresh(spark, feed, detail, result, keys=["id"], groups=["month", "region"], build=total) == ["01", "02", "03", "04", "06"]
    months = {f.split("month=")[1][:2] for f in read if "month=" in f}
    assert months == {"01", "02", "03", "04", "06"}  # the fifth is untouched
    columns = ["id", "month", "region", "cost", "note"]
    read_text = lambda layer: layer.read(spark).withColumn("month", F.format_string("%02d", F.col("month").cast("int")))
    assert rows(read_text(detail).select(columns)) == rows(new)
    assert rows(read_text(result).select("month", "region", "cost", "n")) == rows(total(new).select("month", "region", "cost", "n"))
    assert not (tmp_path / "result" / "month=03").exists()
    before = rows(result.read(spark))
    refresh(spark, feed, detail, result, keys=["id"], groups=["month", "region"], build=total)  # repeated
    assert rows(result.read(spark)) == before
    assert refresh(spark, feed.where("false"), detail, result, keys=["id"], groups=["month", "region"], build=total) == []


def test_partitions_are_swapped_in_without_another_shuffle_and_each_step_frees_its_own(spark, tmp_path, versions, monkeypatch):
    from cargolens.plans import incremental

    old, new = versions
    detail, result = Layer(f"{tmp_path}/detail", "month"), Layer(f"{tmp_path}/result", "month")
    shuffled, freed, write = [], [], incremental._write
    monkeypatch.setattr(incremental, "_write", lambda df, *a: (shuffled.append(a[-1]), write(df, *a))[1])
    monkeypatch.setattr(incremental, "free_shuffles", freed.append)
    detail.create(old)
    result.create(total(old))
    feed = changes.change_feed(old, new, ["id"])
    refresh(spark, feed, detail, result, keys=["id"], groups=["month", "region"], build=total)
    assert shuffled[:2] == [detail.path, result.path] and ["__swap_" in s for s in shuffled[2:]] == [True, True]
    assert len(freed) == 5  # every write that shuffles
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith(("detail", "result"))) == ["detail", "result"]
    assert rows(detail.read(spark).select("id", "cost")) == rows(new.select("id", "cost"))


AT = datetime(2024, 1, 1, 10)


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_lateness_goes_over_the_whole_table(spark, ranges):
    taken = [(k, AT + timedelta(seconds=(k * 37) % 1000 if k % 3 else k * 10)) for k in range(300)] + [(300, None), (301, AT)] + [(302, AT)] * 2
    frame = spark.createDataFrame([(k, k // 50, t) for k, t in taken], "seq long, moment long, event_timestamp timestamp").repartition(5)
    got = {r["seq"]: r["lag_seconds"] for r in lateness.lateness(frame, ["moment", "seq"], ranges=ranges).collect()}
    newest = None
    for k, t in taken:
        want = None if t is None else max(0.0, (newest - t).total_seconds()) if newest else 0.0
        assert got[k] == want, k
        newest = max(x for x in (newest, t) if x) if newest or t else None
    hours = lateness.late_by_hour(lateness.lateness(frame, ["moment", "seq"], ranges=ranges), 60).collect()
    assert sum(r["row_count"] for r in hours) == len(taken) and max(r["late_count"] for r in hours) > 50


def deviation(spark, lat, lon, stops):
    where = spark.createDataFrame([("d", lat, lon)], "delivery_id string, latitude double, longitude double")
    way = spark.createDataFrame([("d", i, a, b) for i, (a, b) in enumerate(stops)][::-1], "delivery_id string, stop int, latitude double, longitude double")
    return trends.route_deviation(where, way, 5.0).first()


def test_deviation_from_the_planned_way_by_hand(spark):
    degree = math.pi * 6371 / 180
    along = [(0.0, 10.0), (0.0, 11.0)]  # a leg on the equator
    assert deviation(spark, 0.04, 10.5, along)["deviation_km"] == pytest.approx(0.04 * degree)
    assert deviation(spark, 0.04, 10.5, along)["is_off_route"] == 0
    assert deviation(spark, 0.05, 10.5, along)["is_off_route"] == 1
    assert deviation(spark, 0.0, 9.5, along)["deviation_km"] == pytest.approx(0.5 * degree)  # before the start
    assert deviation(spark, 0.0, 11.25, along)["deviation_km"] == pytest.approx(0.25 * degree)  # beyond the end
    corner = [*along, (1.0, 11.0)]  # and north from there
    assert deviation(spark, 0.5, 11.1, corner)["deviation_km"] == pytest.approx(math.asin(math.sin(math.radians(0.1)) * math.cos(math.radians(0.5))) * 6371)
    assert deviation(spark, 0.0, 10.0, [(0.0, 10.0), (0.0, 10.0)])["deviation_km"] == 0.0  # a leg without length
    assert deviation(spark, 1.0, 10.0, [(0.0, 10.0)])["deviation_km"] == pytest.approx(degree)
    assert tuple(deviation(spark, None, 10.0, along))[-2:] == (None, 0)
    assert tuple(trends.route_deviation(spark.createDataFrame([("x", 1.0, 1.0)], "delivery_id string, latitude double, longitude double"), spark.createDataFrame([("d", 0, 0.0, 0.0)], "delivery_id string, stop int, latitude double, longitude double"), 5.0).first())[-2:] == (None, 0)


def test_a_feed_of_versions_dealt_by_key_shuffles_neither_again(spark):
    keys = [None, "a", "b", "c"]
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k string, v int")
    old, new = (df.repartition(8, "k") for df in (rows, rows.withColumn("v", F.when(F.col("k") == "b", 7).otherwise(F.col("v") + F.col("k").isNull().cast("int")))))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        feed = changes.change_feed(old, new, ["k"])
        plan = feed._jdf.queryExecution().executedPlan().toString()
        found = sorted((r["change"], r["k"] or "", r["v"]) for r in feed.collect())
        applied = sorted((r["k"] or "", r["v"]) for r in changes.apply_feed(old, feed, ["k"]).collect())
    finally:
        spark.conf.set(key, before)
    # One exchange of each version for the whole keys; the null-safe ones hold the rows with a null key only.
    assert plan.count("Exchange hashpartitioning(k#") == 4 and plan.count("Exchange hashpartitioning(coalesce(k#") == 2
    whole = plan[: plan.index("coalesce(k#")]
    assert "Exchange hashpartitioning(k#" in whole
    assert found == [("update_after", "", 1), ("update_after", "b", 7), ("update_before", "", 0), ("update_before", "b", 2)]
    assert applied == [("", 1), ("a", 1), ("b", 7), ("c", 3)]


def test_what_legs_and_positions_have_of_their_own_is_computed_once(spark):
    where = spark.createDataFrame([("d", 1.0, 1.0)], "delivery_id string, latitude double, longitude double")
    way = spark.createDataFrame([("d", 0, 0.0, 0.0), ("d", 1, 0.0, 2.0), ("d", 2, 2.0, 2.0)], "delivery_id string, stop int, latitude double, longitude double")
    plan = trends.route_deviation(where, way, 5.0)._jdf.queryExecution().optimizedPlan().toString()
    measuring = next(line for line in plan.splitlines() if "ASIN(" in line)
    # The cosines of the two ends' distances; every vector comes from below.
    assert measuring.count("COS(") == 8
    assert plan.count("COS(") < 20
