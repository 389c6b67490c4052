"""Sharding by jump consistent hashing.

The shard follows from a stable key and the number of shards alone: no ring table, no state.
Each key walks a pseudorandom sequence of jumps and stays at the last bucket below the shard
count, so an appended shard takes its fair part of the keys and no other key moves.

The law is ``key``. Slots number the rows of a shard without gaps in the order of (key, row);
they come from sums per range and shard, so no task holds a whole shard, and a key that
fills a third of the rows (all in one shard, as the law asks) is spread over many ranges.

Defined results: a null key hashes like one fixed value; null text has 16 bytes of size and
checksum 0; repeated rows land in the same shard with different slots; an empty table gives an
empty table; ``assign`` keeps extra columns and replaces those named like its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.llm.common import numbered, ready, running

#: The generator of the published algorithm (Lamping and Veach, 2014).
MULTIPLIER = np.uint64(2862933555777941757)
DRAWS = float(1 << 31)
#: What a row costs besides its text.
ROW_BYTES = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Bucket of every unsigned 64-bit key among ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state, bucket, after = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        bucket[live] = after[live]
        state[live] = state[live] * MULTIPLIER + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        # Jumps grow at most 2**31-fold, so the bucket stays exact in a double below 2**53.
        after[live] = np.minimum((bucket[live] + 1) * (DRAWS / draw), 2.0**53).astype(np.int64)
        live = live[after[live] < shards]
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf(T.IntegerType())
    def run(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return run(F.xxhash64(key))


def assign(rows: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = "grown_shard") -> DataFrame:
    """``rows`` with their shard, and under ``grown`` the shard they have once one more is appended."""
    ready(rows.sparkSession)
    out = rows.withColumn(shard, shard_of(F.col(key), shards))
    return out.withColumn(grown, shard_of(F.col(key), shards + 1)) if grown else out


def place(rows: DataFrame, key: str, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Adds the gapless position of every row in its shard, from 0; all other columns come through, whatever their names."""
    given = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != slot]).alias("given")
    light = rows.select(F.col(key).alias("key"), F.col(shard).alias("shard"), F.lit(1).alias("one"), given)
    placed = running(numbered(light, ["key"]), ["key"], "one", by=["shard"], ready_ranges=True, name="slot")
    return placed.select("given.*", F.col("slot").alias(slot))


def write(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; rows are dealt over several tasks and files per shard."""
    rows.write.partitionBy(shard).mode("overwrite").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by the law ``key``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return place(assign(light, "doc_id", 40), "doc_id").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
