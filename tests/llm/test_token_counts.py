from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cargolens.llm import token_counts
from cargolens.llm.token_counts import CHANGES, Rollup
from tests.llm.cases import documents, odd_documents, odd_rows


def got(df):
    return {(r["source"], r["lang"], r["tokenizer_version"]): (r["documents"], r["tokens"]) for r in df.collect()}


def test_query(spark):
    library, docs, tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter(), Counter()
    for r in documents():
        group = (r["source"], r["lang"], "byte_bpe_50k")
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        docs[group] += n > 0
        tokens[group] += n
    assert got(token_counts.query(spark, "/root/testdata/sf0.001")) == {g: (docs[g], tokens[g]) for g in docs if docs[g]}


def test_batches_add_up_once(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    assert got(rollup.totals()) == {}
    frame = lambda *rows: spark.createDataFrame(rows, CHANGES)
    first = frame(("insert", "a", "en", None, None, "v1", 10), ("insert", "a", "en", None, None, "v1", None), ("insert", None, None, None, None, None, 3))
    assert rollup.commit("1", first) and not rollup.commit("1", first)
    assert got(rollup.totals()) == {("a", "en", "v1"): (2, 10), (None, None, None): (1, 3)}
    rollup.commit("2", frame(("revise", "a", "en", "v1", 10, "v2", 7), ("delete", None, None, None, 3, None, None)))
    rollup.commit("3", frame())
    assert got(rollup.totals()) == {("a", "en", "v1"): (1, 0), ("a", "en", "v2"): (1, 7)}
    (tmp_path / "r" / "broken").mkdir()  # a commit that broke off
    assert got(Rollup(spark, str(tmp_path / "r")).totals()) == {("a", "en", "v1"): (1, 0), ("a", "en", "v2"): (1, 7)}
    with pytest.raises(Exception, match="unknown change"):
        rollup.commit("4", frame(("update", "a", "en", None, None, "v1", 1)))
    with pytest.raises(ValueError):
        rollup.commit("../x", frame())


def test_totals_are_maintained(spark, tmp_path):
    place = str(tmp_path / "r")
    rollup = Rollup(spark, place, fold_after=3)
    frame = lambda *rows: spark.createDataFrame(rows, CHANGES)
    batch = lambda k: frame(("insert", "a", "en", None, None, "v1", k), ("insert", None, f"l{k}", None, None, None, 1))
    expected, read = Counter(), []
    for k in range(1, 9):
        assert rollup.commit(f"b{k}", batch(k))
        expected["a", "en", "v1"] += k
        expected[None, f"l{k}", None] += 1
        assert {g: t for g, (_, t) in got(rollup.totals()).items()} == expected
        read.append(len({f.rsplit("/", 1)[0] for f in rollup.totals().inputFiles()}))
    assert max(read) <= 3  # the totals and the batches since, not all that were ever committed
    before = got(rollup.totals())
    assert rollup.batches() == [f"b{k}" for k in range(1, 9)]
    for k in (1, 8):  # folded and open
        assert not rollup.commit(f"b{k}", batch(k))
        with pytest.raises(ValueError, match="other content"):
            rollup.commit(f"b{k}", batch(k + 1))
    assert rollup.sweep() > 0 and got(rollup.totals()) == before
    assert not Rollup(spark, place).commit("b2", batch(2)) and got(Rollup(spark, place).totals()) == before
    assert rollup.fold() == 2 and rollup.fold() == 0 and got(rollup.totals()) == before


def test_a_fold_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    rollup = Rollup(spark, str(tmp_path / "r"))
    frame = lambda *rows: spark.createDataFrame(rows, CHANGES)
    rollup.commit("1", frame(("insert", "a", "en", None, None, "v1", 10)))
    before = got(rollup.totals())

    def stop(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rollup, "_publish", stop)
        with pytest.raises(OSError):
            rollup.fold()
        with pytest.raises(OSError):
            rollup.commit("2", frame(("insert", "a", "en", None, None, "v1", 5)))
    assert got(rollup.totals()) == before and rollup.batches() == ["1"]
    assert rollup.commit("2", frame(("insert", "a", "en", None, None, "v1", 6))) and rollup.fold() == 2
    assert got(rollup.totals()) == {("a", "en", "v1"): (2, 16)}


def test_two_writers_of_a_batch(spark, tmp_path, monkeypatch):
    place = str(tmp_path / "r")
    rollup = Rollup(spark, place)
    rows = spark.createDataFrame([("insert", "a", "en", None, None, "v1", 10)], CHANGES)
    publish, calls = rollup._publish, []

    def later(name, content):
        if not calls:
            calls.append(name)
            assert Rollup(spark, place).commit("1", rows)  # the other writer is faster
        publish(name, content)

    monkeypatch.setattr(rollup, "_publish", later)
    assert not rollup.commit("1", rows)
    assert got(rollup.totals()) == {("a", "en", "v1"): (1, 10)}


def test_counts_of_odd_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = odd_documents(spark).withColumn("n", token_counts.count_tokens(F.col("text"), path)).collect()
    assert [r["n"] for r in rows] == [len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in odd_rows()]


def test_texts_without_tokens_count_as_documents(spark, tmp_path):
    odd_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    library, docs, tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter(), Counter()
    for r in odd_rows():
        group = (r[3], r[2], "byte_bpe_50k")
        docs[group] += 1
        tokens[group] += len(library.encode(r[1] or "", add_special_tokens=False).ids)
    assert got(token_counts.query(spark, str(tmp_path))) == {g: (docs[g], tokens[g]) for g in docs}
