from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolens.streaming import keyed, seen

SCHEMA = "k string, version long, tie string, note string, at timestamp, n int"
AT = datetime(2024, 5, 1)


def feed(spark, folder, rows, name, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/in/{name}")
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in")


def drained(stream, folder, ttl=None):
    """Runs the query over what is new; returns its updates."""
    updates = []
    spark = stream.sparkSession
    with keyed.rocksdb(spark):
        query = (
            keyed.latest(stream, ["k"], ["version", "tie"], ttl).writeStream.outputMode("update")
            .foreachBatch(lambda df, batch_id: updates.extend(map(tuple, df.collect())))
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return updates


def state(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {r["k"]: tuple(r) for r in keyed.snapshot(spark, f"{folder}/checkpoint", schema).collect()}


def test_newer_state_is_never_overwritten_across_restarts(spark, tmp_path):
    first = [("a", 5, "x", "first", AT, 1), ("a", 3, "z", "old", AT, None), ("b", 1, None, None, None, None), (None, 1, "n", "null key", AT, 2)]
    assert sorted(map(str, drained(feed(spark, tmp_path, first, "0"), tmp_path))) == sorted(map(str, [first[0], first[2], first[3]]))
    second = [("a", 4, "z", "stale", AT, 3), ("b", 1, "t", "tie wins over null", AT, 4), ("c", 7, "c", "new", AT, 5)] * 400
    assert sorted(drained(feed(spark, tmp_path, second, "1"), tmp_path)) == sorted(second[1:3])
    assert drained(feed(spark, tmp_path, [first[0], ("b", 0, "zz", "older", AT, 6)], "2"), tmp_path) == []  # a repeat and an older row
    third = ("a", 6, "", "newest", None, None)
    assert drained(feed(spark, tmp_path, [third], "3"), tmp_path) == [third]
    assert state(spark, tmp_path) == {"a": third, "b": second[1], "c": second[2], None: first[3]}


def test_state_without_a_time_to_live_passes_no_row_through_python(spark, tmp_path):
    first = ("a", 5, "x", "first", AT, 1)
    stream = feed(spark, tmp_path, [first], "0")
    plan = keyed.latest(stream, ["k"], ["version", "tie"])._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "MapInArrow" not in plan
    assert drained(stream, tmp_path) == [first]
    assert drained(feed(spark, tmp_path, [("a", 5, "x", "equal in the order", AT, 2)], "1"), tmp_path) == []
    assert state(spark, tmp_path) == {"a": first}


def test_the_state_holds_a_row_once_and_packed(spark, tmp_path):
    rows = [("a", 5, "x", "first", AT, 1), (None, 7, None, None, None, None)]
    drained(feed(spark, tmp_path, rows, "0"), tmp_path)
    held = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").load()

    def leaves(kind):
        return [x for f in kind.fields for x in (leaves(f.dataType) if hasattr(f.dataType, "fields") else [f.name])]

    assert sorted(leaves(held.schema["value"].dataType)) == ["_batch", "_batch", "at", "n", "note", "tie", "version"]
    assert state(spark, tmp_path) == {"a": rows[0], None: rows[1]}
    before = spark.conf.get(keyed.PROVIDER, None)
    with keyed.rocksdb(spark):
        assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.compression") == "zstd"
    assert spark.conf.get(keyed.PROVIDER, None) == before


def test_a_part_is_gone_once_the_stream_has_taken_it(spark, tmp_path):
    from cargolens.plans.maintained import arriving

    taken = []

    def start(stream):
        writer = stream.writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint")
        return [writer.foreachBatch(lambda df, _: taken.extend(r["id"] for r in df.collect())).trigger(availableNow=True).start()]

    arriving([spark.range(k, k + 2) for k in (0, 2, 4)], str(tmp_path), start)
    assert sorted(taken) == [0, 1, 2, 3, 4, 5] and not list((tmp_path / "arriving").iterdir())


def test_a_key_is_forgotten_after_its_time_to_live(spark, tmp_path):
    import time

    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(key, "false")  # a clock would keep a drained stream running
    try:
        ttl = timedelta(milliseconds=200)
        assert drained(feed(spark, tmp_path, [("a", 9, "x", "first", AT, 1)], "0"), tmp_path, ttl)
        time.sleep(1)
        older = ("a", 2, "y", "taken, as nothing is known", AT, 2)
        assert drained(feed(spark, tmp_path, [older], "1"), tmp_path, ttl) == [older]
    finally:
        spark.conf.unset(key)


def test_one_row_of_a_key_leaves_an_arrow_batch(spark):
    rows = [("hot" if k % 3 else f"k{k}", k % 7, str(k), None, None, k) for k in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    kept = keyed.thinned(frame, ["k"], ["version", "tie"]).where("k = 'hot'").collect()
    assert len(kept) == 1 and (kept[0]["version"], kept[0]["tie"]) == max((r[1], r[2]) for r in rows if r[0] == "hot")


IDS = "event_id string, at timestamp, note string"


def stored(spark, tables):
    return sorted((r["event_id"] or "", r["note"]) for r in seen.read_history(spark, tables).collect())


@pytest.mark.parametrize("buckets, hashes", [(64, 4), (1, 4), (1, 0)])
def test_an_id_repeated_a_month_later_adds_no_row(spark, tmp_path, monkeypatch, buckets, hashes):
    """One bucket makes many, and no hash at all only, false positives: none may lose a row."""
    if hashes == 0:
        monkeypatch.setattr(seen, "known", lambda bits, place: F.lit(True))
    tables = seen.SeenTables(str(tmp_path))
    month = lambda k: AT + timedelta(days=31 * k)
    batches = [
        [(f"a{k}", month(0), "first") for k in range(300)] + [("a1", month(0) + timedelta(hours=1), "again")],
        [(f"a{k}", month(1), "month later") for k in range(0, 300, 7)] + [(f"b{k}", month(1), "first") for k in range(50)] + [(None, month(1), "no id")] * 2,
        [("a5", month(3), "again"), ("b5", month(3), "again"), ("c", None, "no time"), ("c2", month(3), "first")],
        [("c", month(4), "again"), ("c2", month(0), "again, before")],
    ]
    for k, rows in enumerate(batches):
        seen.write_batch(spark.createDataFrame(rows, IDS), k, tables, "event_id", "at", buckets)
    want = sorted([(f"a{k}", "first") for k in range(300)] + [(f"b{k}", "first") for k in range(50)] + [("", "no id")] * 2 + [("c", "no time"), ("c2", "first")])
    assert stored(spark, tables) == want
    seen.write_batch(spark.createDataFrame(batches[1], IDS), 1, tables, "event_id", "at", buckets)  # replayed
    assert stored(spark, tables) == want


def test_a_filter_knows_all_its_ids_and_few_others(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("id-"), F.col("id")).alias("id"), F.lit("202405").alias("month"))
    filters = seen.filters_of(ids, 8)
    others = spark.range(20_000).select(F.concat(F.lit("other-"), F.col("id")).alias("id"))
    assert seen.maybe(ids.select("id"), filters, 8).count() == 20_000
    assert seen.maybe(others, filters, 8).count() < 600


def test_history_is_read_in_the_months_asked_only(spark, tmp_path):
    tables = seen.SeenTables(str(tmp_path))
    seen.write_batch(spark.createDataFrame([(f"m{k}", AT + timedelta(days=31 * k), "") for k in range(6)], IDS), 0, tables, "event_id", "at")
    files = seen.unseen(spark.createDataFrame([("m2", AT, ""), ("new", AT, "")], IDS), tables, 1, "event_id").inputFiles()
    assert {f.split("event_month=")[1][:6] for f in files if "/history/" in f} == {"202407"}
