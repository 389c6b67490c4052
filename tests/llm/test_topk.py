from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cargolens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string"


def plain(rows, k, asked):
    usable = [(n, r[0], [math.floor(1024 * float(x)) for x in r[1]]) for n, r in enumerate(rows) if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for n, i, v in usable:
        if asked(i):
            best = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for m, j, w in usable if m != n)[:k]
            out += [(i, rank, j, -s) for rank, (s, j, _) in enumerate(best, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_query(spark):
    import pyarrow.parquet as pq

    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()]
    assert got(topk.query(spark, "/root/testdata/sf0.001")) == plain(rows, 10, lambda i: i % 100 == 0)


def test_refinement_ties_and_small_blocks(spark, monkeypatch):
    for name, value in (("QUERY_BLOCK", 3), ("CANDIDATE_BLOCK", 7), ("BINS", 4), ("FEW", 2)):
        monkeypatch.setattr(topk, name, value)
    rows = [(k, [0.5, 0.25]) for k in range(40)] + [(k, [k / 64, 1 - k / 50]) for k in range(40, 100)]
    frame = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], SCHEMA).repartition(5)
    assert got(topk.top_k(frame, F.col("id") % 20 == 0, 10)) == plain(rows, 10, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, []), (6, [3.0]), (-2, [-1.0, 0.1]), (7, [1e6, -1e6])]
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    assert got(topk.top_k(frame, F.col("id") % 2 == 0, 3)) == plain(rows, 3, lambda i: i % 2 == 0)
    assert got(topk.top_k(frame.where("false"), F.col("id") % 2 == 0, 3)) == []
    assert got(topk.top_k(frame, F.col("id") == 99, 3)) == []
    one = frame.where("vec_id = 6")
    assert got(topk.top_k(one, F.col("id") == 6, 3)) == []


def test_products_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e12], 1, "", ""), (1, [1e12], 1, "", "")], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(frame, F.col("id") == 0, 1).collect()
