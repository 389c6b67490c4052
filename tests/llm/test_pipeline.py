from __future__ import annotations

import importlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cargolens.llm import bpe
from tests.llm.cases import DOCS, no_documents, odd_documents, words
from tests.llm.test_bpe import PATH, expected, library  # noqa: F401
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_mixing import plain_targets
from tests.llm.test_ngram_join import plain as plain_groups
from tests.llm.test_quality import plain_kept

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and every stage's output, each written and read again."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    columns = docs.columns
    found.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, found[-1], FOLDER).write.parquet(path)
        found.append(spark.read.parquet(path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert found[-1].columns == columns
    return [sorted(f.collect(), key=str) for f in found]


def test_stages_are_those_of_the_plan():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]
    assert importlib.import_module("__spark_entry__").queries()["pipeline"] is corpus_pipeline.run


def test_quality_stage(steps):
    kept = {k for k, *_, ok in plain_kept([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in steps[0]]) if ok}
    assert steps[1] == [r for r in steps[0] if r["doc_id"] in kept]


def test_line_stage(steps):
    rows = sorted(((r["doc_id"], r["text"]) for r in steps[1]), key=lambda r: r[0])
    assert sorted(((r["doc_id"], r["text"]) for r in steps[2]), key=str) == plain_lines(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2])


def test_group_stage(steps):
    smallest = {k: c for k, _, c in plain_groups([(r["doc_id"], r["text"]) for r in steps[2]])}
    assert steps[3] == [r for r in steps[2] if smallest[r["doc_id"]] == r["doc_id"]]


def test_mix_stage(steps):
    sizes, got = defaultdict(int), defaultdict(int)
    whole = {r["doc_id"]: Counter(words(r["text"])) for r in steps[3]}
    for r in steps[3]:
        sizes[r["source"]] += len(words(r["text"]))
    taken = defaultdict(Counter)
    for r in steps[4]:
        got[r["source"]] += len(words(r["text"]))
        taken[r["doc_id"]] += Counter(words(r["text"]))
    for source, target in plain_targets(sizes).items():
        assert abs(got[source] - target) <= 1
    for k, count in taken.items():
        assert all(n <= 3 * whole[k][w] for w, n in count.items())


def test_encoding_stage(steps, library):  # noqa: F811
    want = sorted((r["doc_id"], r["lang"], r["source"], *expected(library, r["text"])) for r in steps[4])
    assert sorted(tuple(r[c] for c in ("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")) for r in steps[5]) == want


def test_run_gives_the_rows_of_the_stages(spark, steps):
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, steps[5]), key=str)


def test_odd_and_empty_tables_pass_every_stage(spark, tmp_path):
    for name, frame in (("odd", odd_documents(spark)), ("none", no_documents(spark))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            frame.write.parquet(str(tmp_path / f"{name}{k}"))
            frame = stage(spark, spark.read.parquet(str(tmp_path / f"{name}{k}")), FOLDER)
            assert k == len(corpus_pipeline.STAGES) - 1 or frame.columns == DOCS.names
        frame.count()


def test_digests_come_from_decoded_ids(spark):
    rows = bpe.digests(odd_documents(spark).where(F.col("text").isNotNull()), PATH).join(odd_documents(spark).select("doc_id", F.sha2("text", 256).alias("s")), "doc_id")
    assert {r["decoded_sha256"] == r["s"] for r in rows.where("doc_id <> 5").collect()} == {True}
