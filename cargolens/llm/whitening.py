"""Embedding whitening from an exact scatter matrix, counted on bit slices.

Entries become whole numbers. Every dimension is shifted by its smallest value, so that few bits are left, and each bit of
each dimension is packed across rows into 64-bit words: a bit plane. The product sum of two
dimensions is the sum over their planes of 2**(i+j) times the number of rows that have both bits, which is the population count of
the two planes' AND. Tasks add up counts of their rows and send one number per pair of dimensions; these are added as exact
decimals. With row count and sums, also exact, the scatter is centred as whole numbers (n * products - sums * sums) before it
becomes a matrix of doubles, whose eigenvectors are the components. The rows are then centred as whole numbers, projected and scaled.

The fit counts each distinct vector once; it is written to the shared folder and read by all passes. The driver holds
one number per pair of dimensions, never rows.

Defined results: vectors that are null or hold nulls, NaN or infinities take no part; entries missing at the end of a vector that
is shorter than the longest count as 0; a null key stays null; repeated rows are all returned and counted once in the fit; a component
whose eigenvalue is nothing beside the largest (``NOTHING``) has no direction to scale: its whitened values are 0, and the error measure leaves
it out; a table without usable rows gives an empty table; only key and vector are read, so other columns cannot clash.
Entries beyond 2**49 after scaling, or a deviation beyond 64 bits, are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import ready, stage

SCALE, SHIFT = 64, 1_000_000
#: Rows whose bit planes are packed at once.
ROWS = 1 << 13
#: An eigenvalue of at most this share of the largest counts as none.
NOTHING = 1e-13
_EXACT = Context(prec=38)


@dataclass(frozen=True)
class Model:
    """Fit of ``n`` distinct vectors: sums per dimension, eigenvalues (falling) and unit eigenvectors as columns."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    axes: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        """One over the deviation along each component; 0 where there is none."""
        real = self.values > NOTHING * max(self.values.max(initial=0.0), 0.0)
        return np.where(real, 1 / np.sqrt(np.where(real, self.values, 1.0)), 0.0)


def whole(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(key, x)``: the usable vectors, entries as ``floor(SCALE * c) + SHIFT``."""
    entry = F.col(embedding)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    large = F.exists(entry, lambda c: F.abs(c.cast("double")) >= 2.0**49 / SCALE)
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    fits = F.when(large, F.raise_error(F.lit("an entry is beyond 2**49")).cast("array<bigint>")).otherwise(x)
    usable = vectors.where(entry.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return usable.select(F.col(key).alias("key"), fits.alias("x"))


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column; what a short one lacks is the whole number of 0."""
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.value_lengths())
    if (lengths == width).all():
        return flat.reshape(len(lists), width).astype(np.int64)
    out = np.full((len(lists), width), SHIFT, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def in_pieces(batches: Iterator[pa.RecordBatch], name: str, width: int, rows: int = ROWS) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield matrix(batch.slice(at, rows).column(batch.schema.get_field_index(name)), width)


def decimals(numbers: list[int]) -> pa.Array:
    return pa.array([_EXACT.create_decimal(v) for v in numbers], pa.decimal128(38, 0))


def moments(fit: DataFrame, width: int) -> list:
    """Per dimension: rows, sum, smallest and largest value; ``width`` rows in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, [0] * width, None, None
        for x in in_pieces(batches, "x", width):
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0), strict=True)]  # a piece of 2**13 rows stays within 64 bits
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            columns = [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), decimals(sums), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "n", "total", "low", "high"])

    parts = fit.select("x").mapInArrow(run, "d int, n long, total decimal(38,0), low long, high long")
    return parts.groupBy("d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()


def planes(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the columns of ``x`` (not negative, ``bits`` bits each), packed across rows into 64-bit words."""
    words = -(-len(x) // 64)
    out = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, count in enumerate(bits.tolist()):
        for b in range(count):
            packed = np.packbits((x[:, d] >> b & 1).astype(bool))
            out[at, : len(packed)] = packed
            at += 1
    return out.view(np.uint64)


def scatter(fit: DataFrame, low: np.ndarray, bits: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums of products of the shifted dimensions, for each pair ``i <= j``."""
    owner = np.repeat(np.arange(len(bits)), bits)
    place = np.concatenate([np.arange(b) for b in bits]) if len(bits) else np.zeros(0, np.int64)
    width = len(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(owner), len(owner)), np.int64)
        for x in in_pieces(batches, "x", width):
            sliced = planes(x - low, bits)
            for k in range(len(sliced)):
                counts[k, k:] += np.bitwise_count(sliced[k] & sliced[k:]).sum(axis=1, dtype=np.int64)
        if not counts.any():
            return
        totals: dict[tuple[int, int], int] = {}
        for a, b in zip(*np.nonzero(counts), strict=True):
            weight = 1 << int(place[a] + place[b])
            i, j = int(owner[a]), int(owner[b])
            # Inside one dimension, a pair of different planes stands for both of its orders.
            totals[i, j] = totals.get((i, j), 0) + int(counts[a, b]) * weight * (2 if i == j and a != b else 1)
        pairs = list(totals)
        columns = [pa.array([p[k] for p in pairs], pa.int32()) for k in (0, 1)] + [decimals([totals[p] for p in pairs])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, total decimal(38,0)")
    return {(r["i"], r["j"]): int(r["total"]) for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}


def fitted(rows: DataFrame) -> tuple[Model, DataFrame] | None:
    """The model of ``rows(key, x)`` and its staged fit list; None without rows."""
    fit = stage(rows.select("x").distinct(), "fit")
    width, shortest = fit.agg(F.max(F.size("x")), F.min(F.size("x"))).head()
    if width is None:
        return None
    if shortest < width:  # filled up, a short vector may equal another one
        rest = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x"))
        fit = stage(fit.select(F.concat("x", rest).alias("x")).distinct(), "fit")
    facts = moments(fit, width)
    n, sums = (facts[0]["n"], [int(r["total"]) for r in facts]) if width else (fit.count(), [])
    low = np.array([r["low"] for r in facts], np.int64)
    bits = np.array([(r["high"] - r["low"]).bit_length() for r in facts], np.int64)
    products = scatter(fit, low, bits)
    shifted = [s - n * int(v) for s, v in zip(sums, low, strict=True)]
    covariance = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):  # centred as whole numbers, then divided once
            covariance[i, j] = covariance[j, i] = (n * products.get((i, j), 0) - shifted[i] * shifted[j]) / (n * n)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    return Model(n, tuple(sums), float(np.trace(covariance)), np.maximum(values[order], 0.0), axes[:, order]), fit


def centred(x: np.ndarray, model: Model) -> np.ndarray:
    """``n * x - sums`` exactly: whole numbers of 64 bits where they fit, else of any size."""
    reach = model.n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums), default=0)
    kind = np.int64 if reach < 1 << 62 else object
    return x.astype(kind) * model.n - np.array(model.sums, kind)


def squares(gaps: np.ndarray) -> np.ndarray:
    """Exact sums of squares per row; an error where 64 bits do not hold one."""
    largest = int(np.abs(gaps).max(initial=0))
    if largest * largest * max(gaps.shape[1], 1) < 1 << 63:
        return (gaps * gaps).sum(axis=1).astype(np.int64)
    sums = [sum(int(v) * int(v) for v in row) for row in gaps]
    if max(sums) >= 1 << 63:
        raise ArithmeticError("a deviation is beyond 64 bits")
    return np.array(sums, np.int64)


def projected(gaps: np.ndarray, model: Model, components: int) -> np.ndarray:
    count = min(components, len(model.sums))
    return (gaps.astype(np.float64) / model.n) @ model.axes[:, :count] * model.scales[:count]


def identity_error(fit: DataFrame, model: Model, components: int) -> float:
    """Largest entry by which the covariance of the whitened fit list differs from the identity."""
    count = min(components, len(model.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, seen = np.zeros(count), np.zeros((count, count)), False
        for x in in_pieces(batches, "x", len(model.sums)):
            w = projected(centred(x, model), model, components)
            first, second, seen = first + w.sum(axis=0), second + w.T @ w, True
        if seen:
            flat = np.concatenate([first, second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["k", "v"])

    parts = fit.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    flat = np.array([r["v"] for r in parts])
    mean, second = flat[:count] / model.n, flat[count:].reshape(count, count) / model.n
    real = model.scales[:count] > 0
    gap = np.abs(second - np.outer(mean, mean) - np.eye(count))[np.ix_(real, real)]
    return float(gap.max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 16, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per usable vector: key, n, deviation, and arrays ``whitened`` and ``explained`` by component; ``identity_error`` is one value."""
    ready(vectors.sparkSession)
    rows = whole(vectors, key, embedding)
    found = fitted(rows)
    kind = vectors.schema[key].dataType.simpleString()
    out = f"key {kind}, n long, deviation long, whitened array<double>"
    if found is None:
        empty = vectors.sparkSession.createDataFrame([], f"{out}, explained array<double>, identity_error double")
        return empty.withColumnRenamed("key", key)
    model, fit = found
    error = identity_error(fit, model, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                gaps = centred(matrix(part.column(1), len(model.sums)), model)
                values = projected(gaps, model, components)
                offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel()))
                arrays = [part.column(0), pa.array(np.full(part.num_rows, model.n, np.int64)), pa.array(squares(gaps)), lists]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "deviation", "whitened"])

    shares = [float(v / model.trace) if model.trace > 0 else 0.0 for v in model.values[:components]]
    explained = F.array(*map(F.lit, shares)).cast("array<double>")
    return rows.mapInArrow(run, out).select(F.col("key").alias(key), "n", "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def query(spark, sf_dir: str) -> DataFrame:
    """Whitened values of all embeddings along the first 16 components, a row each."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = found.select("vec_id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("_at", "_of"), "identity_error")
    return each.select(
        "vec_id", (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("_of.whitened").alias("whitened"), F.col("_of.explained").alias("explained"), "identity_error",
    )
