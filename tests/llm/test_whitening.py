from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from cargolens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, key string, x string, n string, whitened string"


def usable(rows):
    return [(r[0], [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]]) for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def plain(rows):
    """n, sums and the exact covariance as fractions, over the distinct vectors."""
    fit = sorted({tuple(x) for _, x in usable(rows)})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    gaps = [[n * x[k] - sums[k] for k in range(d)] for x in fit]
    return n, sums, np.array([[float(Fraction(sum(g[i] * g[j] for g in gaps), n**3)) for j in range(d)] for i in range(d)])


def check(found, rows, components=16):
    n, sums, v = plain(rows)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    d = len(sums)
    got: dict = {}
    for r in found:
        got.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    want = [(k, sum((n * a - s) ** 2 for a, s in zip(x, sums)), x) for k, x in usable(rows)]
    assert sorted((str(k), dev) for k, dev, _ in want) == sorted((str(r["vec_id"]), r["deviation"]) for r in found if r["component"] == 1)
    assert {r["n"] for r in found} == {n} and {r["component"] for r in found} == set(range(1, min(d, components) + 1))
    signs: dict = {}
    for key, dev, x in want:
        for r in got[key, dev]:
            c = r["component"] - 1
            assert r["explained"] == pytest.approx(values[c] / v.trace(), rel=1e-6)
            expect = float((np.array(x) - np.array(sums) / n) @ axes[:, c] / math.sqrt(values[c]))
            if abs(expect) > 1e-6:
                assert abs(r["whitened"]) == pytest.approx(abs(expect), rel=1e-6)
                signs.setdefault(c, set()).add(expect * r["whitened"] > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-4


def exploded(df):
    from pyspark.sql import functions as F

    each = df.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"))
    return [r.asDict() | {"component": r["at"] + 1, "whitened": r["of"]["whitened"], "explained": r["of"]["explained"]} for r in each.collect()]


def test_query(spark):
    import pyarrow.parquet as pq

    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()]
    df = whitening.query(spark, "/root/testdata/sf0.001")
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check([r.asDict() for r in df.collect()], rows)


def test_scatter_is_exact_over_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 7)
    draw = random.Random(3)
    rows = [[draw.choice([-3, 0, 5, 1 << 40]) + draw.randrange(100), draw.randrange(2), 9] for _ in range(150)]
    fit = spark.createDataFrame([(r,) for r in rows], "x array<bigint>").repartition(4)
    low = np.array([-3, 0, 9])
    got = whitening.scatter(fit, low, np.array([42, 1, 0]))
    shifted = [[a - b for a, b in zip(r, low.tolist())] for r in rows]
    want = {(i, j): sum(r[i] * r[j] for r in shifted) for i in range(3) for j in range(i, 3)}
    assert {k: v for k, v in want.items() if v} == got


def test_copies_count_once_and_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    draw = random.Random(5)
    real = [(k, [draw.gauss(0, 1 + d) for d in range(5)]) for k in range(60)]
    rows = [*real, *real[:20], (900, real[0][1]), (None, real[1][1]), (901, None), (902, [None] * 5), (903, [nan, 0.0, 0.0, 0.0, 0.0]), (904, [inf, 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "a", None, "b", "c") for r in rows], SCHEMA).repartition(3)
    check(exploded(whitening.whiten(frame)), rows)
    check(exploded(whitening.whiten(frame, components=2)), rows, 2)


def test_short_empty_single_and_constant_vectors(spark):
    frame = lambda rows: spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    assert whitening.whiten(frame([])).collect() == whitening.whiten(frame([(1, None)])).collect() == []
    one = whitening.whiten(frame([(1, [2.0, 3.0])] * 3)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, [0.0, 0.0], [0.0, 0.0], 0.0)] * 3
    empty = whitening.whiten(frame([(1, []), (2, [])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in empty] == [(1, 0, [])] * 2
    short = whitening.whiten(frame([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])])).collect()
    assert {(r["vec_id"], r["n"], r["deviation"]) for r in short} == {(1, 2, 64**2 + 128**2), (2, 2, 64**2 + 128**2), (3, 2, 64**2 + 128**2)}
    flat = whitening.whiten(frame([(k, [float(k), 7.0]) for k in range(9)])).collect()
    assert all(r["whitened"][1] == 0.0 and r["explained"][0] == 1.0 and r["identity_error"] < 1e-9 for r in flat)


def test_entries_beyond_the_bound_are_an_error(spark):
    with pytest.raises(Exception, match="2\\*\\*49"):
        whitening.whiten(spark.createDataFrame([(1, [3e30], "", "", "", "")], SCHEMA)).collect()
