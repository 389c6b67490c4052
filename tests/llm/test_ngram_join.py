from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cargolens.llm import ngram_join, shingles
from tests.llm.cases import DOCS, documents, no_documents, odd_documents, odd_rows, words


def plain_set(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows):
    """(doc_id, n, component) by comparing every pair."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(k)
    smallest = {r: min((k for k in ks if k is not None), default=None) for r, ks in groups.items()}
    return sorted(((k, len(s), smallest[root(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_hashed_sets_equal_plain_ones():
    rng = random.Random(3)
    texts = [r[1] for r in odd_rows()] + ["".join(rng.choice(["a", "b ", "C", "\n", " d", "é"]) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    plain_sets, found, keys = [plain_set(t) for t in texts], {}, {}
    for s in shingles.of_texts(pa.array(texts, pa.string()), 5):
        for i in range(len(s.sizes)):
            found[s.first + i] = set(s.hashes[s.bounds[i] : s.bounds[i + 1]].tolist())
        keys |= dict(enumerate(s.keys().tolist(), s.first))
    assert [len(found[i]) for i in range(len(texts))] == [len(s) for s in plain_sets]
    for _ in range(20000):
        i, j = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert len(found[i] & found[j]) == len(plain_sets[i] & plain_sets[j])
        assert (keys[i] == keys[j]) == (plain_sets[i] == plain_sets[j])


def test_runs_of_any_length_give_the_same_sets(monkeypatch):
    texts = pa.array([r[1] for r in odd_rows()], pa.string())
    whole = np.concatenate([s.hashes for s in shingles.of_texts(texts, 5)])
    monkeypatch.setattr(shingles, "GO", 10)
    assert (np.concatenate([s.hashes for s in shingles.of_texts(texts, 5)]) == whole).all()


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents()]
    want = plain(rows)
    assert any(k != c for k, _, c in want)
    assert got(ngram_join.query(spark, "/root/testdata/sf0.001")) == want


def test_groups_of_near_copies_frequent_columns_and_chains(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", 20)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = []
    for k in range(90):  # near copies
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = word()
        rows.append((k, " ".join(w)))
    chain = [word() for _ in range(100)]
    for k in range(90, 130):  # each close to the next only
        chain = chain[4:] + [word() for _ in range(4)]
        rows.append((k, " ".join(chain)))
    for k in range(130, 190):  # a passage in unlike documents
        rows.append((k, " ".join([word() for _ in range(rng.randint(10, 60))] + passage + [word() for _ in range(30)])))
    rows += [(k, rows[k - 190][1]) for k in range(190, 240)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(k, t, None, None, 0, "", "", 1) for k, t in rows], DOCS).repartition(6)
    assert got(ngram_join.classes(frame)) == plain(rows)


def test_odd_rows(spark):
    assert got(ngram_join.classes(odd_documents(spark))) == plain([(r[0], r[1]) for r in odd_rows()])
    assert got(ngram_join.classes(no_documents(spark))) == []


def test_one_document_of_each_group_stays(spark):
    kept = ngram_join.one_of_each(odd_documents(spark))
    assert kept.columns == DOCS.names
    ids = [r["doc_id"] for r in kept.collect()]
    assert {0, 1, 2, 3, 5} <= set(ids) and not {6, 7} & set(ids) and ids.count(5) == 1 and None not in ids
    assert ngram_join.one_of_each(no_documents(spark)).count() == 0


def test_rows_whose_parity_differs_too_much_never_meet(spark):
    random = np.random.default_rng(7)
    sets = [np.unique(random.integers(0, 1 << 63, n, np.uint64)) for n in (300, 40, 1)]
    sets += [sets[0][20:], np.zeros(0, np.uint64)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    words = np.array(ngram_join.parity(np.concatenate(sets), bounds)).view(np.uint64).T
    apart = lambda a, b: sum(int(w).bit_count() for w in words[a] ^ words[b])
    assert all(apart(a, b) <= len(np.setxor1d(sets[a], sets[b])) for a in range(5) for b in range(5))
    assert apart(2, 4) == 1 and 0 < apart(0, 3) <= 20 < apart(0, 1)
    schema = "node long, n long, rest int, label long, column long, p0 long, p1 long, p2 long, p3 long"
    left = spark.createDataFrame([(1, 45, 44, 1, 5, 0, 0, 0, 0)], schema)
    right = spark.createDataFrame([(2, 45, 44, 2, 5, 0, 0, 0, 1023), (3, 45, 44, 3, 5, 0, 7, 0, 1023)], schema)
    # 90 columns in all: linked sets differ in ten at most.
    assert [tuple(r) for r in ngram_join.products(left, right).collect()] == [(1, 2)]


def test_no_product_is_made_where_too_few_columns_follow(spark):
    schema = "node long, n long, rest int, label long, column long, p0 long, p1 long, p2 long, p3 long"
    row = lambda node, rest, column: (node, 45, rest, node, column, 0, 0, 0, 0)
    left = spark.createDataFrame([row(1, 44, 5), row(1, 38, 6), row(1, 40, 7)], schema)
    # 40 of 45 must be shared: 39 at a column and after it are too few on either side, however many columns precede.
    right = spark.createDataFrame([row(2, 38, 5), row(3, 44, 6), row(4, 39, 7), row(5, 39, 5)], schema)
    assert sorted(tuple(r) for r in ngram_join.products(left, right).collect()) == [(1, 4), (1, 5)]
    assert sorted(tuple(r) for r in ngram_join.products(left, right, whole=False).collect()) == [(1, 2), (1, 3), (1, 4), (1, 5)]


def test_a_loose_group_of_near_copies(spark):
    rng = random.Random(11)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(240):
        w = list(base)
        for at in rng.sample(range(0, 150, 5), rng.randint(1, 4)):
            w[at] = f"v{rng.randrange(3)}"
        rows.append((k, " ".join(w)))
    frame = spark.createDataFrame([(k, t, None, None, 0, "", "", 1) for k, t in rows], DOCS).repartition(6)
    assert got(ngram_join.classes(frame)) == plain(rows)


def test_hubs_are_of_the_largest_component_and_differ_between_columns(spark):
    rows = [(c, v, 9, 8, v // 10, 1, 0, 0, 0, 0) for c in range(40) for v in range(30)]  # node 10 to 19 have the label 1
    schema = "column long, node long, n long, rest int, label long, major long, p0 long, p1 long, p2 long, p3 long"
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    hubs = lambda turn: [r[0] for r in frame.groupBy("column").agg(F.min(ngram_join.hub_order(turn)).alias("h")).select("h.node").collect()]
    first, second = set(hubs(0)), set(hubs(1))
    assert first | second <= set(range(10, 20))
    assert 1 < len(first) <= ngram_join.HUBS < len(second)


def test_large_sets_that_differ_too_much_are_not_fetched_whole(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 57, 1000)
    # 900 columns that may be shared and 20 alone; of 1,840 columns linked sets differ in 204 at most.
    sets = [(k, 920, [int(c) for c in base[k * at : k * at + 900]]) for k, at in ((0, 0), (1, 82), (2, 45), (3, 33))]
    wide = ngram_join.wide_parity(spark.createDataFrame(sets, "node long, n long, columns array<long>"))
    words = {r["node"]: [r[f"w{k}"] % (1 << 64) for k in range(ngram_join.WIDE)] for r in wide.collect()}
    for node, _, columns in sets:
        bits = [0] * ngram_join.WIDE
        for c in columns:
            bits[(c >> 6) % ngram_join.WIDE] ^= 1 << (c & 63)
        assert words[node] == bits
    assert {r["alone"] for r in wide.collect()} == {20}
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (1, 2), (2, 3)], "a long, b long")
    kept = {tuple(r) for r in ngram_join.close(pairs, wide).collect()}
    columns = {node: set(c) for node, _, c in sets}
    for a, b in [tuple(r) for r in pairs.collect()]:
        if 9 * (40 + len(columns[a] ^ columns[b])) <= 1840:
            assert (a, b) in kept
    far = spark.createDataFrame([(8, 920, [int(c) for c in rng.integers(0, 1 << 57, 900)]), sets[0]], "node long, n long, columns array<long>")
    assert ngram_join.close(spark.createDataFrame([(0, 8)], "a long, b long"), ngram_join.wide_parity(far)).isEmpty()
