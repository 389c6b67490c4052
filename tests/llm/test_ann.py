from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import ann

SCHEMA = "vec_id long, embedding array<float>, row string, id string, q string, c string"


def usable(rows):
    wide = max((len(r[1]) for r in rows if r[1]), default=0)
    kept = [(m, r[0], [float(np.float32(x)) for x in r[1]]) for m, r in enumerate(rows) if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    return [(m, i, np.array(v + [0.0] * (wide - len(v)))) for m, i, v in kept]


def plain(rows, k, asked):
    """query row -> its k best, ties to the smaller id."""
    found = usable(rows)
    every = np.array([v for *_, v in found])
    every = every / np.sqrt((every * every).sum(axis=1, keepdims=True))
    out = {}
    for a, (m, i, _) in enumerate(found):
        if asked(i):
            s = every @ every[a]
            out[m, i] = sorted((-round(float(s[b]), 12), j) for b, (w, j, _) in enumerate(found) if w != m)[:k]
    return out


def by_query(df):
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_recall_order_and_scores(spark, sf):
    import pyarrow.parquet as pq

    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()]
    want, got = plain(rows, 5, lambda i: i % 50 == 0), by_query(ann.query(spark, f"/root/testdata/{sf}"))
    vectors = {i: v for _, i, v in usable(rows)}
    hits = 0
    assert set(got) == {i for _, i in want}
    for (_, q), best in want.items():
        assert [r for r, *_ in got[q]] == [1, 2, 3, 4, 5]
        for _, i, score in got[q]:
            a, b = vectors[q], vectors[i]
            assert score == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-14)
        assert got[q] == sorted(got[q], key=lambda x: (-x[2], x[1]))
        hits += len({j for _, j in best} & {i for _, i, _ in got[q]})
    assert hits >= 0.99 * 5 * len(want)


def test_the_bound_holds_and_spares_most_of_the_work():
    draw = np.random.default_rng(1)
    v, q = draw.standard_normal((3000, 48)), draw.standard_normal((20, 48))
    codes, a = ann.codes_of(v)
    coded, miss, width = ann.Queries(ann.unit(q)), 0, []
    for k in range(len(q)):
        estimate, bound = coded.against(k, codes, a)
        miss += int((np.abs(estimate - ann.cosines(q[k], v)) > bound).sum())
        width.append(bound.mean())
    assert miss <= 0.002 * v.shape[0] * q.shape[0] and np.mean(width) < 0.2
    assert codes.nbytes == 3000 * 32


def test_ties_copies_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "INDEX_ROWS", 16)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    draw = random.Random(2)
    copy = [draw.gauss(0, 1) for _ in range(9)]
    rows = [(k, copy) for k in range(120)] + [(k, [draw.gauss(0, 1) for _ in range(9)]) for k in range(120, 200)] + [(120, copy)]
    frame = spark.createDataFrame([(*r, "a", "b", None, "d") for r in rows], SCHEMA).repartition(6)
    got = by_query(ann.nearest(frame.where("vec_id <> 120"), F.col("id") % 40 == 0, 4))
    for q in (0, 40, 80):
        assert [i for _, i, _ in got[q]] == [i for i in range(6) if i != q][:4]
    want = plain([r for r in rows if r[0] != 120], 4, lambda i: i == 160)
    assert [i for _, i, _ in got[160]] == [j for _, j in next(iter(want.values()))]
    assert set(got) == {0, 40, 80, 160}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, []), (6, [3.0]), (-2, [-1.0, 0.1]), (7, [1e30, -1e30]), (8, [0.0, 0.0]), (9, [1e-30, 3e-30])]
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["score"], r["vec_id"]) for r in ann.nearest(frame, F.col("id") % 2 == 0, 3).collect())
    want = sorted((i, rank, -s, j) for (_, i), best in plain(rows, 3, lambda i: i % 2 == 0).items() for rank, (s, j) in enumerate(best, 1))
    assert [(q, rank, i) for q, rank, _, i in got] == [(q, rank, i) for q, rank, _, i in want]
    assert [s for _, _, s, _ in got] == pytest.approx([s for _, _, s, _ in want], abs=1e-9)
    for none in (frame.where("false"), frame.where("vec_id = 8")):
        assert ann.nearest(none, F.col("id") % 2 == 0, 3).collect() == []
    assert ann.nearest(frame, F.col("id") == 99, 3).collect() == []
    assert ann.nearest(frame.where("vec_id = 6"), F.col("id") == 6, 3).collect() == []


def test_query_blocks_meet_index_blocks_by_block_number(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = ann.query(spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert len(exchanges) == 3 and all("hashpartitioning(c#" in x or "hashpartitioning(q_row#" in x for x in exchanges)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_copies_of_query_blocks_are_never_broadcast(spark):
    """Blocks are small, their copies for all index blocks are not, and Spark's size check sees the blocks only."""
    draw = np.random.default_rng(4)
    frame = spark.createDataFrame([(k, draw.standard_normal(4).tolist()) for k in range(40)], "vec_id long, embedding array<double>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        found = ann.nearest(frame, F.col("id") % 10 == 0, 3)
        assert {q for q in by_query(found)} == {0, 10, 20, 30}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
