"""Latest row per key, and table changes by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` tuple of each key.

    A ``row_number() = 1`` filter is pushed below the shuffle as a group limit, so
    each map task sends at most one row per key and a hot key stays small.
    """
    ranking = Window.partitionBy(*keys).orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") == 1).drop("_rank")


def _known_keys(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``rows`` that ``base`` holds.

    While they are few enough to broadcast, the base is only scanned for its key
    columns and never shuffled.
    """
    asked = rows.select(*keys).distinct()
    return base.select(*keys).join(asked, keys, "left_semi").distinct()


def upsert(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], update: Sequence[str], version: Sequence[str], *, few: bool = True
) -> DataFrame:
    """Insert-or-update: a known key takes the ``update`` columns, a new key its whole row.

    Several changes of one key collapse to the latest by ``version``. ``base`` is only
    ever the streamed side of a left or semi join: while the changes are small enough
    to broadcast it is not shuffled, and beyond that its hot keys can still be split.
    Changes that are about as many as the base (``few=False``) meet it in one full join instead: each side is
    read once, and shuffled once unless it comes dealt by the keys.
    """
    keys = list(keys)
    delta = latest_by_key(changes, keys, version)
    if not few:
        return _upsert_whole(base, delta, keys, update)
    renamed = delta.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit"))
    updated = base.join(renamed, keys, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in base.columns
        ]
    )
    added = delta.join(_known_keys(base, changes, keys), keys, "left_anti")
    return updated.unionByName(added.select(*base.columns))


def _upsert_whole(base: DataFrame, delta: DataFrame, keys: list[str], update: Sequence[str]) -> DataFrame:
    """A key that is null in part is never known, so such rows of both sides stay apart in the join."""
    known = base.withColumn("_known", F.lit(True))
    named = delta.select(*[F.col(c).alias(f"_new_{c}") for c in base.columns], F.lit(True).alias("_hit"))
    both = known.join(named, [known[c] == named[f"_new_{c}"] for c in keys], "full_outer")
    taken = lambda c: F.col("_hit") if c in update else F.col("_known").isNull()
    return both.select(*[F.when(taken(c), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in base.columns])


def insert_absent(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``base`` lacks, one per key; ready to append."""
    keys = list(keys)
    return latest_by_key(new, keys, order).join(_known_keys(base, new, keys), keys, "left_anti")
