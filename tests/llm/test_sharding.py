from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np

from cargolens.llm import sharding
from tests.llm.cases import documents, no_documents, odd_documents


def plain_jump(key: int, shards: int) -> int:
    bucket, after = -1, 0
    while after < shards:
        bucket = after
        key = (key * 2862933555777941757 + 1) % 2**64
        after = int((bucket + 1) * (2**31 / ((key >> 33) + 1)))
    return bucket


def test_jump_equals_its_published_loop_and_moves_rows_only_to_the_new_shard():
    keys = np.random.Generator(np.random.PCG64(1)).integers(0, 2**64, 5000, np.uint64)
    last = None
    for shards in range(1, 42):
        got = sharding.jump(keys, shards)
        assert got.tolist() == [plain_jump(int(k), shards) for k in keys[:200]] + got[200:].tolist()
        if last is not None:
            moved = got != last
            assert (got[moved] == shards - 1).all()
        last = got
    counts = np.bincount(sharding.jump(keys, 10))
    assert counts.min() > 400 and counts.max() < 600


def test_query(spark):
    rows = sharding.query(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in documents()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_keep_their_columns_and_equal_keys_meet(spark):
    rows = sharding.place(sharding.assign(odd_documents(spark), "doc_id", 3), "doc_id").collect()
    assert len(rows) == odd_documents(spark).count()
    assert len({r["shard"] for r in rows if r["doc_id"] == 5}) == 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["before"] for r in rows if r["doc_id"] == 4} == {4}
    assert sharding.place(sharding.assign(no_documents(spark), "doc_id", 3), "doc_id").count() == 0


def test_written_shards_read_back(spark, tmp_path):
    sharding.write(sharding.assign(odd_documents(spark), "doc_id", 3), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd_documents(spark).count()


def test_names_that_the_code_uses_come_through(spark):
    names = ["_p", "_offset", "_one", "_tie", "_part", "_inside", "_row", "key", "one", "given", "slot", "a.b"]
    rows = spark.createDataFrame([(k, *[f"{n}{k}" for n in names]) for k in range(50)], ["doc_id", *names])
    got = sharding.place(sharding.assign(rows, "doc_id", 3, grown=None), "doc_id")
    assert got.columns == ["doc_id", *[n for n in names if n != "slot"], "shard", "slot"]
    found = [r.asDict() for r in got.collect()]
    assert all(r[n] == f"{n}{r['doc_id']}" for r in found for n in names if n != "slot")
    slots = {s: sorted(r["slot"] for r in found if r["shard"] == s) for s in range(3)}
    assert all(v == list(range(len(v))) for v in slots.values()) and sum(map(len, slots.values())) == 50
