"""What several operators share: staged tables, running totals, file access and links to components."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.session import shared_dir
from cargolens.streaming.slices import remove

#: The ASCII white space that ends a word.
SPACE = "[\\x20\\x09-\\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it is not installed but lies on the same path."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
    return spark


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Of the tables staged inside, only the last one stays: it must hold all that is needed of the others.

    They go once it is committed; if something fails before, they are left to the shared folder's expiry.
    """
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.pop()
    for path in made[:-1]:
        remove(spark, path)
    if _scratch:
        _scratch[-1].extend(made[-1:])


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Writes ``df`` to the cluster's shared folder and reads it back: what follows survives lost executors.

    Spark removes the shuffle files of finished steps when the driver collects its garbage, so it is asked to.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    if _scratch:
        _scratch[-1].append(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text (null: none), split at ASCII white space only."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Range-partitioned by ``order`` and staged, with ``_part`` and ``_tie``: together a total order.

    Rows that are equal in ``order`` keep the order of the input's partitions, so one value
    that fills a third of the rows still spreads over many ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    spread = tied.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order], "_tie")
    return stage(spread.withColumn("_part", F.spark_partition_id()), "ranges")


def running(df: DataFrame, order: list[str], value: str, by: list[str] | None = None, ready_ranges: bool = False, name: str = "before") -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the earlier rows of the same ``by`` group.

    Two levels: sums inside each range, and totals of ranges (one row per range and group),
    so no task holds a whole group.
    """
    by = by or []
    ranged = df if ready_ranges else numbered(df, order)
    keys = [F.col(c).asc_nulls_first() for c in order]
    inside = Window.partitionBy("_part", *by).orderBy(*keys, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part", *by).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_by_{c}") for c in by], F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    match = F.col("_part") == F.col("_p")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    placed = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(offsets, match)
    before = (F.col("_inside") + F.col("_offset")).cast("long").alias(name)
    return placed.select(*[c for c in ranged.columns if c != name], before)


def filesystem(uri: str):
    """Arrow file system and path of a shared folder, as tasks write and read it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id of ``links(a, b)``; component is the smallest id it reaches.

    Contraction: every label takes its smallest neighbouring label, chains are cut by
    pointer jumping, and links inside a label drop out. Each round is a written table.
    """
    edges = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = stage(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("v"), F.least("a", "p").alias("p"))
        parent = stage(parent, "parents")
        while True:  # a parent is never larger than its child: a forest, halved in depth each time
            up = parent.select(F.col("v").alias("w"), F.col("p").alias("q"))
            parent = stage(parent.join(up, F.col("p") == F.col("w")).select("v", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), "parents")
            if not parent.where("moved").limit(1).count():
                break
            parent = parent.drop("moved")
        parent = parent.select("v", "p")
        labels = stage(
            labels.join(parent, F.col("component") == F.col("v"), "left").select("id", F.coalesce("p", "component").alias("component")), "labels"
        )
        roots = lambda side: parent.select(F.col("v").alias(f"{side}v"), F.col("p").alias(f"{side}p"))
        edges = stage(
            edges.join(roots("a"), F.col("a") == F.col("av")).join(roots("b"), F.col("b") == F.col("bv"))
            .select(F.col("ap").alias("a"), F.col("bp").alias("b")).where("a <> b").distinct(),
            "links",
        )
        if edges.isEmpty():
            return labels
    raise RuntimeError("links did not contract")
