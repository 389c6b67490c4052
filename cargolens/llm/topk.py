"""Exact top-k inner products by distributed histogram selection.

Vectors become whole numbers, so scores are exact integers. Query blocks meet candidate blocks;
each pair of blocks scores everything by one matrix product. The scores fall into a histogram per
query over the current score range; the sums of all blocks tell in which bin the k-th
value lies, and the next round refines that bin, until it is one value wide or holds few rows. The last
round keeps what reaches the threshold and ranks it by (score, smaller id, row).

A block reports the bins from its own k-th best score up: with k scores there already, the
global k-th value is not below, so nothing is lost and a block sends about k rows per query. Of equal scores a block
keeps the k smallest ids. So a vector that fills a third of the table costs no more than others.

Defined results: vectors that are null or hold nulls, NaN or infinities take no part, nor do rows
without an id; of vectors of different length the common prefix counts; an empty vector
scores 0; repeated rows are rows of their own (each a candidate, and a query of its own); fewer
than k candidates give all; an empty table gives an empty table; extra columns are not read.
A product that may leave 64 bits is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.llm.common import ready, stage

SCALE = 1024
#: Rows of a query block and of a candidate block.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 2048
#: Bins of a histogram round, and the rows in a bin below which it needs no refinement.
BINS, FEW = 4096, 64


def whole(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(row, id, v, norm2)``: the usable vectors as whole numbers, staged so that row numbers stay."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    usable = vectors.where(F.col(key).isNotNull() & F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    v = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = usable.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), v.alias("v"))
    return stage(rows.withColumn("norm2", norm2), "vectors")


def blocks(rows: DataFrame, size: int, count: int, name: str, *extra: str) -> DataFrame:
    """Rows packed into ``ceil(count / size)`` blocks of about ``size``: parallel arrays per block."""
    number = max(1, math.ceil(count / size))
    block = F.pmod(F.xxhash64("row"), F.lit(number)).cast("int").alias(name)
    packed = rows.groupBy(block).agg(F.collect_list(F.struct("row", "id", "v", *extra)).alias("_list"))

    def field(c: str) -> Column:
        return F.transform("_list", lambda x: x[c])

    arrays = [field(c).alias(f"{name}_{c}") for c in ("row", "id", *extra)]
    lengths = F.transform("_list", lambda x: F.size(x["v"])).alias(f"{name}_len")
    return packed.select(name, *arrays, lengths, F.flatten(field("v")).alias(f"{name}_v"))


def column(batch: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name))[k].values.to_numpy(zero_copy_only=False)


def matrix(lengths: np.ndarray, flat: np.ndarray, width: int) -> np.ndarray:
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def scores(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """Every inner product of the two blocks in one row; the query's own row counts as absent (smallest integer)."""
    q_len, c_len = column(batch, "q_len", k), column(batch, "c_len", k)
    width = int(max(q_len.max(initial=0), c_len.max(initial=0)))
    a, b = matrix(q_len, column(batch, "q_v", k), width), matrix(c_len, column(batch, "c_v", k), width)
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if largest < 2.0**53:  # exact in doubles, and fast
        out = (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    else:  # partial sums may wrap around; the sum itself fits, as top_k has seen to
        out = a @ b.T
    own = column(batch, "q_row", k)[:, None] == column(batch, "c_row", k)[None, :]
    out[own] = ABSENT
    return out


ABSENT = np.iinfo(np.int64).min


def top_k(vectors: DataFrame, queries: Column, k: int, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per query row (``queries`` is a condition on ``id``) its k best candidates: query_id, rank, vec_id, score."""
    spark = ready(vectors.sparkSession)
    rows = whole(vectors, key, embedding)
    asked = rows.where(queries)
    n, n_asked, longest = (x or 0 for x in (rows.count(), asked.count(), rows.agg(F.max("norm2")).head()[0]))
    if longest and longest >= 2.0**62:
        raise ArithmeticError("an inner product may leave 64 bits")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    n_blocks = max(1, math.ceil(n_asked / QUERY_BLOCK))
    candidates = stage(blocks(rows, CANDIDATE_BLOCK, n, "c"), "candidates")
    # Each candidate block goes to each query block: all rows, in blocks.
    spread = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).repartition(parts, "c", "q")

    def pairs(state: DataFrame, *extra: str) -> DataFrame:
        return spread.join(blocks(state, QUERY_BLOCK, n_asked, "q", *extra), "q").drop("norm2")

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(batch.num_rows):
                found = scores(batch, j)
                row, low, width = (column(batch, f"q_{c}", j) for c in ("row", "low", "width"))
                if found.shape[1] > k:
                    least = np.partition(found, found.shape[1] - k, axis=1)[:, found.shape[1] - k]
                else:
                    least = np.full(len(found), ABSENT)
                out = []
                for i in range(len(found)):
                    s = found[i]
                    s = s[(s != ABSENT) & (s >= max(low[i], least[i]))]
                    bins, counts = np.unique(np.minimum((s - low[i]) // width[i], BINS), return_counts=True)
                    out.append((np.full(len(bins), row[i]), bins, counts))
                if out:
                    cols = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["row", "bin", "n"])

    # |q . c| <= |q| |c|: the first range holds every score. One bin more counts what lies above it.
    reach = F.ceil(F.sqrt("norm2") * math.sqrt(longest or 0.0) * (1 + 1e-9)) + 1
    state = asked.select("row", "id", "v", (-reach).cast("long").alias("low"), F.greatest(F.lit(1), F.ceil((2 * reach + 1) / BINS)).cast("long").alias("width"))
    state = stage(state.withColumn("settled", F.lit(False)), "state")
    while n_asked and n and not state.where("NOT settled").isEmpty():
        counted = pairs(state.where("NOT settled"), "low", "width").mapInArrow(histogram, "row long, bin long, n long")
        bins = counted.groupBy("row", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("row").orderBy(F.desc("bin"))
        reached = bins.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= k)
        at = reached.groupBy("row").agg(F.max(F.struct("bin", "n", "upto")).alias("at"))
        # No bin reaches k: fewer candidates than that, all are kept from the lower end.
        low = F.when(F.col("at").isNull(), F.col("low")).otherwise(F.col("low") + F.col("at.bin") * F.col("width"))
        done = F.col("at").isNull() | (F.col("width") == 1) | (F.col("at.n") <= FEW)
        width = F.when(done, F.col("width")).otherwise(F.ceil(F.col("width") / BINS)).cast("long")
        state = stage(
            state.join(at, "row", "left").select(
                "row", "id", "v",
                F.when(F.col("settled"), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("settled"), F.col("width")).otherwise(width).alias("width"),
                (F.col("settled") | done).alias("settled"),
            ),
            "state",
        )

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(batch.num_rows):
                found = scores(batch, j)
                row, ids, low = (column(batch, f"q_{c}", j) for c in ("row", "id", "low"))
                c_row, c_id = column(batch, "c_row", j), column(batch, "c_id", j)
                out = []
                for i in range(len(found)):
                    s = found[i]
                    kept = np.flatnonzero((s >= low[i]) & (s != ABSENT))
                    kept = kept[np.lexsort((c_row[kept], c_id[kept], -s[kept]))[:k]]
                    out.append((np.full(len(kept), row[i]), np.full(len(kept), ids[i]), c_id[kept], c_row[kept], s[kept]))
                if out:
                    cols = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["row", "query_id", "vec_id", "c_row", "score"])

    found = pairs(state, "low").mapInArrow(reaching, "row long, query_id long, vec_id long, c_row long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "c_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all vectors for every vector whose id is divisible by 100."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, 10)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
