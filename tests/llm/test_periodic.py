from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from cargolens.llm import periodic
from tests.llm.cases import documents, no_documents, odd_documents, odd_rows, words


def plain(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    """Every period on its own; a stretch counts if no smaller period holds it."""
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i:
                s, n = i, j - i + q
                if n >= max(least, 2 * q) and not any(all(w[k] == w[k + d] for k in range(s, s + n - d)) for d in range(1, q)):
                    found.append((s, n, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated(key, text) -> list[str]:
    w = words(text)
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(w)
    if key is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def expected(key, w: list[str], runs) -> tuple:
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(x for k, x in enumerate(w) if k not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (key, len(runs), *best, milli, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    w: list[int] = []
    while len(w) < draw.choice([5, 30, 90, 160]):
        block = [draw.randrange(draw.choice([1, 2, 3, 40])) for _ in range(draw.randrange(1, 12))]
        w += block * draw.choice([1, 1, 2, 3, 5]) + block[: draw.randrange(len(block) + 1)]
    assert periodic.runs_in(w) == plain(w)
    assert periodic.runs_in(w, 2) == plain(w, 2)
    texts = [[b"%d" % x for x in w], [], [b"%d" % x for x in w[::-1]], [b"a"] * 12, [b"a"] * 11]
    assert periodic.in_documents(texts) == [plain(t) for t in texts]


def test_words_outside_repeated_windows_skip_the_automaton():
    import numpy as np

    draw = random.Random(1)
    noise = lambda n: [draw.randrange(10**6) for _ in range(n)]
    passage = noise(20)
    w = noise(50) + passage + noise(50) + passage + noise(3) + [1, 2, 3, 4, 5, 6, 7] * 4 + noise(9)
    names: dict = {}
    ids = np.array([names.setdefault(x, len(names)) for x in w])
    assert periodic.stretches(ids, np.zeros(len(w), np.int64)) == [(143, 171)]


def test_query(spark):
    docs = [(d["doc_id"], repeated(d["doc_id"], d["text"])) for d in documents()]
    want = []
    for key, w in docs:
        runs = plain(w) if len(w) < 400 else periodic.runs_in([hash(x) for x in w])
        want.append(expected(key, w, runs))
    got = [tuple(r) for r in periodic.query(spark, "/root/testdata/sf0.001").collect()]
    assert order(got) == order(want)
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(spark):
    want = [expected(r[0], words(r[1]), plain(words(r[1])) if len(words(r[1])) < 500 else [(0, len(words(r[1])), 1)]) for r in odd_rows()]
    got = [tuple(r) for r in periodic.digests(periodic.find(odd_documents(spark))).collect()]
    assert order(got) == order(want)
    assert periodic.digests(periodic.find(no_documents(spark))).collect() == []


def test_very_long_text(spark):
    block = " ".join(f"w{k}" for k in range(40_000))
    frame = spark.createDataFrame([(1, f"x {block} {block} y")], "doc_id long, text string")
    row = periodic.find(frame).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 80_000, 40_000)] and row["collapsed"] == f"x {block} y"
