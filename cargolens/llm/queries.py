"""The queries of this folder, each over its whole table, and the SQL checks of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query name and the module of this folder whose ``query(spark, sf_dir)`` builds it.
MODULES = {
    "op1_bpe": "bpe",
    "op2_ngram_join": "ngram_join",
    "op3_line_dedup": "line_dedup",
    "op4_mixing": "mixing",
    "op5_token_counts": "token_counts",
    "op6_sharding": "sharding",
    "op7_quality_rules": "quality",
    "op8_warc": "warc",
    "op9_token_files": "token_files",
    "op10_exact_topk": "topk",
    "op11_whitening": "whitening",
    "op12_ann": "ann",
    "op13_periodic_runs": "periodic",
}




def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: import_module(f"cargolens.llm.{module}").query for name, module in MODULES.items()}


def statements() -> dict[str, str]:
    found = {name: getattr(import_module(f"cargolens.llm.{module}"), "SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
