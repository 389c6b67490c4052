"""Change feeds: what turns one version of a table into another, and how to apply it.

A version holds each key once (``latest_by_key`` sees to that). Both are shuffled once, on the key, and not again if they come dealt by it; rows that are equal in
every column drop out before the images are made. Nulls and NaN equal themselves, in keys as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OP = "change"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in keys])


def _both(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join on keys in which null equals null.

    A null-safe condition hashes other expressions than the key columns, so Spark would shuffle versions once more that come
    dealt by their key. Whole keys are therefore joined by plain equality, and the few that hold a null apart. The former
    are told by both sides together: a condition on one side would reach its source and keep a shared shuffle from being used again.
    """
    any_null = lambda values: reduce(lambda a, b: a | b, [v.isNull() for v in values])
    named = lambda df, side: df.withColumnsRenamed({c: f"{side}{i}" for i, c in enumerate(keys)})
    pairs = [(F.col(f"_b{i}"), F.col(f"_a{i}")) for i in range(len(keys))]
    whole = named(before, "_b").join(named(after, "_a"), reduce(lambda a, b: a & b, [b == a for b, a in pairs]), "full_outer")
    whole = whole.where(~any_null([F.coalesce(b, a) for b, a in pairs])).select("_old", "_new")
    left, right = (df.where(any_null([df[c] for c in keys])) for df in (before, after))
    return whole.union(left.join(right, _same_key(left, right, keys), "full_outer").select("_old", "_new"))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both versions that differ, told apart by ``change``: two images of an update, one of an insert or a delete."""
    columns = old.columns
    if set(columns) != set(new.columns):
        raise ValueError(f"versions differ in columns: {sorted(set(columns) ^ set(new.columns))}")
    side = lambda df, name: df.select(*keys, F.struct(*columns).alias(name))
    before, after = side(old, "_old"), side(new, "_new")
    both = _both(before, after, keys)
    changed = both.where(~F.col("_old").eqNullSafe(F.col("_new")))
    image = lambda kind, row: F.struct(F.lit(kind).alias(OP), F.col(row).alias("row"))
    images = (
        F.when(F.col("_old").isNull(), F.array(image(INSERT, "_new")))
        .when(F.col("_new").isNull(), F.array(image(DELETE, "_old")))
        .otherwise(F.array(image(BEFORE, "_old"), image(AFTER, "_new")))
    )
    return changed.select(F.explode(images).alias("_image")).select(f"_image.{OP}", "_image.row.*")


def after_images(feed: DataFrame) -> DataFrame:
    """What a sink that replaces by key takes from a feed: new rows and new images of updated ones."""
    return feed.where(F.col(OP).isin(INSERT, AFTER)).drop(OP)


def apply_feed(base: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` after the feed. Every key of the feed is taken out first, so applying a feed again changes nothing."""
    gone = feed.select(*keys).distinct()
    kept = base.join(gone, _same_key(base, gone, keys), "left_anti")
    return kept.unionByName(after_images(feed).select(*base.columns))
