"""Input columns named like those that operators make for themselves."""

from __future__ import annotations

from cargolens.llm import mixing, ngram_join, quality
from tests.llm.cases import SENTENCE

NAMES = ["_row", "_row_", "label", "_id", "_key", "m", "kept", "_text", "a.b", "epoch", "_spans", "_part", "_tie", "key", "before", "target", "shard"]
LONG = " ".join(f"{SENTENCE} part {k}" for k in range(3))


def table(spark):
    texts = [LONG, LONG, f"{LONG} end", "short", None, " ".join(f"word{k}" for k in range(60))]
    rows = [(k, t, "en", "s", *[f"{n}{k}" for n in NAMES]) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *NAMES])


def whole(df):
    return {r["doc_id"]: r for r in df.collect() if all(r[n] == f"{n}{r['doc_id']}" for n in NAMES)}


def test_all_columns_come_through(spark, tmp_path):
    table(spark).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plain = docs.select("doc_id", "text", "lang", "source")
    for step in (quality.passing, ngram_join.one_of_each):
        got = step(docs)
        assert got.columns == docs.columns
        found = whole(got)
        assert len(found) == got.count() and set(found) == {r["doc_id"] for r in step(plain).collect()}
    assert set(found) == {0, 3, 4, 5}


def test_the_mix_keeps_all_columns(spark, tmp_path):
    table(spark).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = mixing.documents_of(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in NAMES)
    plain = mixing.documents_of(docs.select("doc_id", "text", "lang", "source")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in plain)
