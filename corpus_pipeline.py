"""A training corpus from raw documents: five stages, each a written table for the next.

Every stage but the last returns the columns of ``documents``; its decisions take effect: rejected documents and repeated
lines are gone, one document of each near-duplicate group is left, and the mix repeats or cuts documents to meet
its targets. The last returns the encoded mix.

A stage reads its input several times and takes it to be a table (as ``run`` and callers provide it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cargolens.llm import bpe, line_dedup, mixing, ngram_join, quality
from cargolens.llm.common import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality.passing(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones."""
    return line_dedup.dedup(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, repeated or cut, that meet the targets of their sources."""
    return mixing.documents_of(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, source and language of each document of the mix, its number of tokens, and digests of its ids and of their decoded text."""
    from public_tokenizers import path

    return bpe.digests(docs, path("byte_bpe_50k.json"), also=("lang", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_documents),
]

#: SQL cannot express the mix's draws nor BPE; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
