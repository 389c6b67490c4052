from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from cargolens.llm import mixing
from tests.llm.cases import DOCS, documents, no_documents, odd_documents, odd_rows, words


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def test_permutations_hit_every_index_once_and_invert():
    for n in (1, 2, 3, 5, 16, 17, 1000):
        size, key = np.full(n, n), np.full(n, 77)
        image = mixing.permute(np.arange(n), size, key)
        assert sorted(image) == list(range(n))
        assert mixing.permute(image, size, key, inverse=True).tolist() == list(range(n))


def check(rows, sources):
    sizes = defaultdict(int)
    for _, source, size in sources:
        sizes[source] += size
    want, got, per = plain_targets(sizes), defaultdict(int), defaultdict(int)
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["size"]) for r in rows) == sorted((d is not None, d, n) for d, _, n in sources)
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        got[r["source"]] += r["taken"]
        per[r["source"]] = r["target"]
    for s, target in per.items():
        assert abs(got[s] - target) <= 1, s


def test_query_meets_its_targets_and_repeats_itself(spark):
    docs = documents()
    rows = mixing.taken(mixing.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))).collect()
    check(rows, [(r["doc_id"], r["source"], len(words(r["text"]))) for r in docs])
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = mixing.taken(mixing.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5))).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r["doc_id"]: r["taken"] for r in rows} == {r["doc_id"]: r["taken"] for r in again}


def test_odd_rows(spark):
    check(mixing.taken(mixing.mix(odd_documents(spark), block=16)).collect(), [(r[0], r[3], len(words(r[1]))) for r in odd_rows()])
    assert mixing.taken(mixing.mix(no_documents(spark))).count() == 0
    assert mixing.documents_of(no_documents(spark)).count() == 0


def test_small_sources_are_capped(spark):
    rows = [(k, "w " * n, "en", s, 1, "", "", 1) for k, (n, s) in enumerate([(5, "a"), (1000, "b"), (7, "c"), (700, "d"), (0, "e"), (40, None)])]
    found = mixing.taken(mixing.mix(spark.createDataFrame(rows, DOCS), block=8)).collect()
    check(found, [(r[0], r[3], len(words(r[1]))) for r in rows])


def test_documents_of_holds_the_words_taken(spark):
    docs = odd_documents(spark).where("doc_id <> 5 and doc_id is not null")
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(mixing.mix(docs, block=16)).collect()}
    rows = mixing.documents_of(docs, block=16)
    assert rows.columns == docs.columns
    got, texts = defaultdict(int), {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows.collect():
        got[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
        if len(words(r["text"])) == len(words(texts[r["doc_id"]])):
            assert r["text"] == texts[r["doc_id"]]
    assert sum(got.values()) == pytest.approx(sum(taken.values()), abs=3)
