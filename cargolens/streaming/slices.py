"""Replace-by-version tables on plain files.

A table is a folder of slices. A micro-batch writes its rows to the slice of its own
batch id, so a replayed batch replaces itself; nothing is read or merged while the
stream runs. Readers take the latest version of each key over all slices. Compaction
writes one merged base slice and only then removes the slices it covers: whenever it
stops, what is left still holds every latest version, because merging the same row
twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.operators.latest import latest_by_key
from cargolens.session import free_shuffles
from cargolens.sources.tables import arrange


#: Rows whose latest versions are looked for at a time: what bounds the shuffle files of a slice.
PASS_ROWS = 20_000_000


def delta(batch_id: int) -> str:
    return f"slice=delta-{batch_id:012d}"


def write_slice(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{delta(batch_id)}")


def write_latest_slice(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str], order: Sequence[str]) -> None:
    """The latest row of each key into a slice, in passes over shares of the keys: only one share is shuffled at a time.

    ``rows`` are read once more per pass and should be a table. The success marker comes with the last pass.
    """
    passes = max(1, -(-rows.count() // PASS_ROWS))
    for k in range(passes):
        share = rows.where(F.pmod(F.xxhash64(*keys), F.lit(passes)) == k) if passes > 1 else rows
        writer = latest_by_key(share, keys, order).write.mode("append" if k else "overwrite")
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(k == passes - 1).lower()).parquet(f"{path}/{delta(batch_id)}")
        free_shuffles(rows.sparkSession)


def hold(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The rows of a micro-batch as a written table: parsed once, and whole again after a lost executor."""
    write_slice(rows, path, batch_id)
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/{delta(batch_id)}")


def release(spark: SparkSession, path: str, batch_id: int) -> None:
    remove(spark, f"{path}/{delta(batch_id)}")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_by_key(spark.read.parquet(path).drop("slice"), keys, order)


def _folder(spark: SparkSession, path: str):
    """Hadoop file system of a path and the path itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def folder_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a folder's first partition column, in order."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def slice_names(spark: SparkSession, path: str) -> list[str]:
    """Committed slices; one without its success marker is still being written."""
    fs, root = _folder(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return sorted(n for n in names if n.startswith("slice=") and fs.exists(path_of(root, f"{n}/_SUCCESS")))


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], up_to: int, partitions: int | None = None
) -> list[str]:
    """Merge the slices of batches 0..``up_to`` into one base; returns the slices removed.

    Run it for batches the stream has committed. A reader that listed the folder just
    before the removal has to be run again.
    """
    base = f"slice=base-{up_to:012d}"
    names = slice_names(spark, path)
    covered = [n for n in names if n != base and n.split("-")[1] <= f"{up_to:012d}"]
    if base not in names:
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in covered]).drop("slice")
        merged = latest_by_key(rows, keys, order)
        packed = merged.repartition(partitions, *keys) if partitions else merged
        packed.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/{base}")
    fs, root = _folder(spark, path)
    for name in covered:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)
    return covered


def write_month_slice(rows: DataFrame, path: str, batch_id: int, time: str, sort: Sequence[str], gather: bool = True) -> None:
    """Append-only history by month; the batch id below the month makes a replay harmless.

    Without ``gather`` every task writes the months of its own rows, and none is moved: for wide rows that come dealt by month.
    """
    dated = rows.withColumns({"event_month": F.date_format(time, "yyyyMM"), "batch": F.lit(batch_id)})
    arranged = arrange(dated, "event_month", sort) if gather else dated.sortWithinPartitions("event_month", *sort)
    (
        arranged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "6")
        .partitionBy("event_month", "batch")
        .parquet(path)
    )


def _month_slice(path: str, batch_id: int) -> str:
    return f"{path}/event_month=*/batch={batch_id}"


def has_month_slice(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether a micro-batch wrote any row to a history."""
    fs, pattern = _folder(spark, _month_slice(path, batch_id))
    return bool(fs.globStatus(pattern))


def read_month_slice(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The rows one micro-batch wrote to a history."""
    if not has_month_slice(spark, path, batch_id):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_month_slice(path, batch_id))
