"""Aggregates kept up to date from a change feed.

A group changes when one of its rows comes, goes or is revised; a row that moves changes the group it leaves and the one it
joins, and the feed carries both images. So the touched groups are the distinct group keys of the feed, and
the touched partitions those of its rows: only these are read and replaced, in the detail table and in the
aggregate. A partition that loses its last row is removed.

New contents are written beside the tables first and swapped in by partition. A run that breaks off is repeated with the
same feed: applying it again changes nothing. The shuffle files of each step go before the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.changes import apply_feed
from cargolens.session import free_shuffles
from cargolens.streaming import slices


def _write(rows: DataFrame, partition: str, path: str) -> None:
    rows.hint("rebalance", partition).write.partitionBy(partition).parquet(path, compression="zstd")
    free_shuffles(rows.sparkSession)


@dataclass(frozen=True)
class Layer:
    """A file table: its folder, and the column that partitions it."""

    path: str
    partition: str

    def create(self, rows: DataFrame) -> None:
        _write(rows, self.partition, self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def folder(self, value: object) -> str:
        return f"{self.path}/{self.partition}={value}"

    def some(self, spark: SparkSession, values: Sequence[object], schema) -> DataFrame:
        """Rows of some partitions; the others are not even listed."""
        found = [self.folder(v) for v in values if slices.exists(spark, self.folder(v))]
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path).parquet(*found)

    def replace(self, rows: DataFrame, values: Sequence[object]) -> None:
        """Make ``rows`` the contents of some partitions."""
        spark = rows.sparkSession
        staged = f"{self.path}__swap_{uuid.uuid4().hex[:8]}"
        _write(rows, self.partition, staged)
        filled = set(slices.folder_values(spark, staged, self.partition))
        if filled:
            whole = spark.read.schema(rows.schema).parquet(staged)
            # Staged files are of one partition and of a good size each: they are copied as they lie.
            writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(self.partition).parquet(self.path, compression="zstd")
        for value in {str(v) for v in values} - filled:
            slices.remove(spark, self.folder(value))
        slices.remove(spark, staged)


def _like(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def refresh(
    spark: SparkSession,
    feed: DataFrame,
    detail: Layer,
    result: Layer,
    *,
    keys: Sequence[str],
    groups: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
) -> list:
    """Apply ``feed`` to ``detail`` and recompute the groups of ``result`` it touches; returns the partitions replaced.

    ``build`` makes the aggregate from detail rows, one row per ``groups``. Both tables are partitioned by a function
    of the groups, so a group lies within one partition. ``feed`` is read several times and should be a table.
    """
    # As long as the calendar of the changes, not as the data.
    values = sorted(r[0] for r in feed.select(detail.partition).distinct().collect())
    if not values:
        return []
    schema = feed.drop("change").schema
    rows = apply_feed(detail.some(spark, values, schema), feed, keys)
    detail.replace(rows.select(*[c for c in schema.fieldNames() if c != detail.partition], detail.partition), values)
    touched = feed.select(*groups).distinct()
    current = detail.some(spark, values, schema)
    shape = result.read(spark).schema
    fresh = build(current.join(touched, _like(current, touched, groups), "left_semi")).select(*shape.fieldNames())
    staged = f"{result.path}__fresh_{uuid.uuid4().hex[:8]}"
    fresh.write.partitionBy(result.partition).parquet(staged, compression="zstd")
    free_shuffles(spark)
    known = result.some(spark, values, shape)
    untouched = known.join(touched, _like(known, touched, groups), "left_anti")
    result.replace(untouched.unionByName(spark.read.schema(fresh.schema).parquet(staged)), values)
    slices.remove(spark, staged)
    return values
