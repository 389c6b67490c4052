"""Approximate nearest neighbours by cosine over randomly rotated one-bit codes.

Every vector, scaled to length one, is turned by a fixed random rotation of ``width`` dimensions (it is filled up with zeros; 256 at
least, so that short vectors get more than a bit per dimension). The signs of the result are its code, packed into
64-bit words. With the code seen as a unit vector s, two correction scalars go with it: a = <s, v> and the bound's factor
sqrt(1 - a*a) / a. A query is rotated alike and its coordinates are written as whole numbers of ``PLANES`` bits, so that
<s, q> is a weighted sum of population counts of code AND bit plane. Then <s, q> / a estimates the inner product <v, q>, and
``SPREAD`` * factor * sqrt((1 - <s, q>**2) / (width - 1)) bounds its error but for a chance of about one in a thousand.

The index (every vector with its code) is written in blocks; query blocks are sent to each index block, joined by block
number, so index blocks stay whole and no key is hot. They are always shuffled: Spark takes query blocks for as small as they are before they
are sent to each index block, and would broadcast all the copies through the driver. A first pass reranks the k best estimates of each block exactly, which gives
a threshold per query: the k-th best of all blocks. The second pass reranks, block by block, every vector whose estimate plus bound
reaches it, however many there are, and keeps the k best of a block. Scores are exact cosines of the original vectors in double precision.

Defined results: vectors that are null, zero, empty or hold nulls, NaN or infinities take no part, nor do rows without an id;
entries missing at the end of a vector that is shorter than others count as 0; repeated rows are rows of their own (each a candidate, and a query of
its own); equal scores are ordered by id, then by row; fewer than k candidates give all; an empty table gives an empty table; only id and
vector are read, so other columns cannot clash. Found are nearly all true neighbours: tests hold recall against brute force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import ready, stage

#: Bits of a code at least, bits of a query's coordinate, and the bound in deviations of the estimate.
LEAST_BITS, PLANES, SPREAD = 256, 8, 3.3
#: Rows of an index block and of a query block, and bytes of vectors in either.
INDEX_ROWS, QUERY_ROWS, BLOCK_BYTES = 4096, 512, 8 << 20
_ROUNDING = 1e-9


@cache
def rotation(width: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(7)).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def width_of(dimensions: int) -> int:
    return max(LEAST_BITS, 64 * math.ceil(dimensions / 64))


def usable(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(row, id, v)``: the vectors that take part, as doubles, staged so that row numbers stay."""
    v = F.col(embedding)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    some = F.exists(v, lambda x: x.cast("double") != 0)
    rows = vectors.where(F.col(key).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & some)
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v")), "vectors")


def dense(lists: pa.ListArray, dimensions: int) -> np.ndarray:
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.value_lengths())
    if (lengths == dimensions).all():
        return flat.reshape(len(lists), dimensions)
    out = np.zeros((len(lists), dimensions))
    out[np.arange(dimensions) < lengths[:, None]] = flat
    return out


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest entry first, so that squares stay finite and above zero."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def rotated(units: np.ndarray) -> np.ndarray:
    return units @ rotation(width_of(units.shape[1]))[: units.shape[1]]


def codes_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated rows, and a = <code, vector> of each."""
    turned = rotated(unit(v))
    a = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1).view(np.uint64), a


class Queries:
    """Rotated queries as bit planes of whole numbers: ``low + step * number`` is a coordinate."""

    def __init__(self, units: np.ndarray):
        turned = rotated(units)
        self.width = turned.shape[1]
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-300) / (2**PLANES - 1)
        numbers = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.total = numbers.sum(axis=1)
        self.planes = [np.packbits((numbers >> b & 1).astype(bool), axis=1).view(np.uint64) for b in range(PLANES)]

    def against(self, k: int, codes: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of query ``k`` with the coded vectors, and the bounds of their errors."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        weighted = np.zeros(len(codes), np.int64)
        for b, plane in enumerate(self.planes):
            weighted += np.bitwise_count(codes & plane[k]).sum(axis=1, dtype=np.int64) << b
        # Coordinates count plus where the code has a one, minus elsewhere.
        signed = self.low[k] * (2 * ones - self.width) + self.step[k] * (2 * weighted - self.total[k])
        inner = signed / math.sqrt(self.width)
        rounding = self.step[k] / 2 * math.sqrt(self.width) / a
        rest = np.sqrt(np.maximum(1 - a * a, 0) * np.maximum(1 - inner * inner, 0) / (self.width - 1))
        return inner / a, SPREAD * rest / a + rounding + _ROUNDING


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact cosines of one vector with each row; of parallel rows of one length all are alike, as each is summed by itself."""
    if max(np.abs(q).max(initial=0), np.abs(v).max(initial=0)) > 1e150 or min(np.abs(q).max(), np.abs(v).max(axis=1).min(initial=1)) < 1e-140:
        q, v = q / np.abs(q).max(), v / np.abs(v).max(axis=1, keepdims=True)
    return (v * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1)))


def packed(rows: DataFrame, count: int, dimensions: int, name: str, size: int, coded: bool) -> DataFrame:
    """``rows`` dealt evenly to blocks, one row each: ids, row numbers, vectors and codes as bytes."""
    blocks = max(1, math.ceil(count / max(1, min(size, BLOCK_BYTES // (8 * max(dimensions, 1))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            v = dense(pa.concat_arrays(table["v"].chunks), dimensions)
            columns = [pa.array([TaskContext.get().partitionId()], pa.int32())]
            parts = [table["row"].to_numpy().astype(np.int64), table["id"].to_numpy().astype(np.int64), v]
            if coded:
                parts += codes_of(v)
            columns += [pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [name, *(f"{name}_{c}" for c in ("row", "id", "v", *(("code", "a") if coded else ())))]
    # A block is a partition, dealt round-robin: a bounded number of rows, whatever the ids and vectors are.
    return rows.repartition(blocks).mapInArrow(run, f"{name} int, " + ", ".join(f"{c} binary" for c in names[1:]))


def nearest(vectors: DataFrame, queries: Column, k: int, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per query row (``queries`` is a condition on ``id``) its k nearest candidates found: query_id, rank, vec_id, score."""
    spark = ready(vectors.sparkSession)
    rows = usable(vectors, key, embedding)
    asked = rows.where(queries)
    n, dimensions = rows.agg(F.count("*"), F.max(F.size("v"))).head()
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = stage(packed(rows, n, dimensions, "c", INDEX_ROWS, True), "index")
    blocks = stage(packed(asked, n_asked, dimensions, "q", QUERY_ROWS, False), "queries")
    n_blocks = index.agg(F.max("c")).head()[0] + 1

    def paired(asking: DataFrame) -> DataFrame:
        """Every query block beside every index block."""
        spread = asking.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        return index.join(spread.hint("merge"), "c")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each pair of blocks the k best exact scores: of the k best estimates, or of all that may reach ``least``."""
        for batch in batches:
            for pair in batch.to_pylist():
                read = lambda c, kind: np.frombuffer(pair[c], kind)  # noqa: B023, E731
                q_row, q_id, q_v = read("q_row", np.int64), read("q_id", np.int64), read("q_v", np.float64).reshape(-1, dimensions)
                c_row, c_id, c_v = read("c_row", np.int64), read("c_id", np.int64), read("c_v", np.float64).reshape(-1, dimensions)
                a = read("c_a", np.float64)
                codes = read("c_code", np.uint64).reshape(len(a), -1)
                least = {x["q_row"]: x["score"] for x in pair["least"] or ()} if "least" in pair else None
                coded, out = Queries(unit(q_v)), []
                for i in range(len(q_row)):
                    estimate, bound = coded.against(i, codes, a)
                    own = c_row == q_row[i]
                    if least is None:
                        estimate[own] = -np.inf
                        chosen = np.argpartition(-estimate, min(k, len(a)) - 1)[:k]
                        chosen = chosen[~own[chosen]]
                    else:
                        chosen = np.flatnonzero((estimate + bound >= least.get(int(q_row[i]), -np.inf)) & ~own)
                    score = cosines(q_v[i], c_v[chosen])
                    best = np.lexsort((c_row[chosen], c_id[chosen], -score))[:k]
                    found = chosen[best]
                    out.append((np.full(len(found), q_row[i]), np.full(len(found), q_id[i]), c_id[found], c_row[found], score[best]))
                columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                columns.insert(0, pa.array(np.full(len(columns[0]), pair["q"], np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names=["q", "q_row", "query_id", "vec_id", "c_row", "score"])

    out = "q int, q_row long, query_id long, vec_id long, c_row long, score double"
    down = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "c_row")
    first = paired(blocks).mapInArrow(search, out).withColumn("rank", F.row_number().over(down))
    # The k-th best score of a query so far: what scores less cannot be among its k nearest.
    known = first.where(F.col("rank") == k).select("q", "q_row", "score")
    least = known.groupBy("q").agg(F.collect_list(F.struct("q_row", "score")).alias("least"))  # as many as a block has queries
    bounded = stage(blocks.join(least, "q", "left"), "bounded")
    found = paired(bounded).mapInArrow(search, out).withColumn("rank", F.row_number().over(down))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest of all vectors for every vector whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0, 5)
