"""Exact distinct counts that add up over time.

A count of distinct ids cannot be summed from hours to days. Bitmaps can be merged: per hour and group the ids are marked in
buckets of 32,768 positions, once, and every coarser count comes from these partials without the events. The ids must be
whole numbers from a dense range, such as a fleet's vehicles: a bucket takes four kilobytes before compression whether one id
or all of them are marked, so partials grow with hours, groups and the range of ids, not with events. For ids that are
sparse within an hour and group a plain distinct count moves less.

Null ids are not counted, and a group of nulls only counts 0; rows without a time form an hour of their own (null).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partials(rows: DataFrame, keys: Sequence[str], time: str, number: Column) -> DataFrame:
    """Per hour, group and bucket the marked ids: ``hour``, keys, ``bucket``, ``bits``."""
    marked = rows.select(F.date_trunc("hour", time).alias("hour"), *keys, number.cast("long").alias("_number"))
    bucket, position = F.bitmap_bucket_number("_number").alias("bucket"), F.bitmap_bit_position("_number")
    return marked.select("hour", *keys, bucket, position.alias("_position")).groupBy("hour", *keys, "bucket").agg(F.bitmap_construct_agg("_position").alias("bits"))


def merged(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials of several runs over the same hours as one; marking an id twice changes nothing."""
    return stored.groupBy("hour", *keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(stored: DataFrame, keys: Sequence[str], grain: str, name: str) -> DataFrame:
    """Distinct ids per ``period`` (the start of an hour, day, week or month) and group."""
    period = F.date_trunc(grain, "hour").alias("period")
    buckets = stored.groupBy(period, *keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return buckets.groupBy("period", *keys).agg(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)).alias(name))
