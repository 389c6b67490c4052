"""Upkeep of a history that streams write by month and batch: small files packed, old months expired.

The batches of a month up to a given one are replaced by a list of files, its manifest: files of at least half the
target stay where they are, smaller ones are dealt to bins of the target size and each bin becomes one sorted file. A
manifest is written under a temporary name and renamed to the next version, so a reader sees the list before or after, never
half of it; batches beyond it are read from their folders. Files that no list names are removed by ``sweep``, later, when readers
of the former list are done. Whenever a step stops, what is left reads the same, and running it again finishes the work.

No task holds more than a bin, however many rows a month has; what passes through the driver is the list of one
month's files. A batch must be committed before it is packed (``committed``); rows that a replay writes to a packed batch are
those the packed files hold already, and are not read. An expired month stays expired: rows that come late for it are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cargolens.streaming.slices import _folder, folder_values

TARGET = 256 << 20
MANIFESTS, PACKED = "_manifest", "_packed"


def _list(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and sizes below a folder (none, if it is not there)."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(root))


def _data(spark: SparkSession, path: str, inside: str) -> list[tuple[str, int]]:
    """Data files of a folder of the history, named from its root."""
    return [(f"{inside}/{n}", size) for n, size in _list(spark, f"{path}/{inside}") if n.endswith(".parquet") and n[0] not in "_."]


def _manifest(spark: SparkSession, path: str, month: str) -> tuple[int, dict]:
    """Version and content of a month's manifest; version 0 covers no batch."""
    folder = f"{path}/{MANIFESTS}/event_month={month}"
    versions = [n for n, _ in _list(spark, folder) if n.endswith(".json")]
    if not versions:
        return 0, {"up_to": -1, "files": [], "expired": False}
    fs, file = _folder(spark, f"{folder}/{versions[-1]}")
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(versions[-1].removesuffix(".json")), json.loads(text)


def _commit(spark: SparkSession, path: str, month: str, version: int, content: dict) -> None:
    folder = f"{path}/{MANIFESTS}/event_month={month}"
    fs, temporary = _folder(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    _, final = _folder(spark, f"{folder}/{version:012d}.json")
    if fs.exists(final) or not fs.rename(temporary, final):
        raise RuntimeError(f"version {version} of month {month} was committed by someone else")


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a stream has committed (none: -1)."""
    return max((int(n) for n, _ in _list(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def months(spark: SparkSession, path: str) -> list[str]:
    return sorted({*folder_values(spark, path, "event_month"), *folder_values(spark, f"{path}/{MANIFESTS}", "event_month")})


def _batches(spark: SparkSession, path: str, month: str, after: int) -> list[int]:
    return sorted(int(b) for b in folder_values(spark, f"{path}/event_month={month}", "batch") if int(b) > after)


def live(spark: SparkSession, path: str, month: str) -> list[str]:
    """Files of a month that count: those of its manifest and of the batches beyond it."""
    _, known = _manifest(spark, path, month)
    if known["expired"]:
        return []
    newer = [n for b in _batches(spark, path, month, known["up_to"]) for n, _ in _data(spark, path, f"event_month={month}/batch={b}")]
    return [*known["files"], *newer]


def maintained(spark: SparkSession, path: str) -> bool:
    """Whether a manifest was ever written: from then on only ``read`` tells the rows."""
    return bool(folder_values(spark, f"{path}/{MANIFESTS}", "event_month"))


def _files(spark: SparkSession, files: Sequence[str], schema: StructType | None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(*files)


def read(spark: SparkSession, path: str, schema: StructType | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """Rows of the history, of the months in ``only`` if given, with their ``event_month``; without a schema, that of the files."""
    chosen = [m for m in months(spark, path) if only is None or m in only]
    files = [f"{path}/{name}" for month in chosen for name in live(spark, path, month)]
    month = F.regexp_extract(F.col("_metadata.file_path"), "event_month=([^/]+)/", 1)
    if not files:
        return spark.createDataFrame([], schema or StructType()).withColumn("event_month", F.lit("").cast("string"))
    return _files(spark, files, schema).select("*", month.alias("event_month"))


def bins(sizes: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """Files dealt to bins of at most ``target`` bytes, largest first, each to the fullest bin it fits in."""
    found: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda f: (-f[1], f[0])):
        fitting = [k for k, (used, _) in enumerate(found) if used + size <= target]
        if fitting:
            k = max(fitting, key=lambda k: found[k][0])
            found[k] = (found[k][0] + size, [*found[k][1], name])
        else:
            found.append((size, [name]))
    return [names for _, names in found]


def pack(spark: SparkSession, path: str, month: str, up_to: int, schema: StructType | None, sort: Sequence[str], target: int = TARGET) -> int:
    """Replace the small files of a month's batches up to ``up_to``; returns how many fewer there are."""
    version, known = _manifest(spark, path, month)
    taken = [b for b in _batches(spark, path, month, known["up_to"]) if b <= up_to]
    if known["expired"] or not taken:
        return 0
    folders = sorted({name.rsplit("/", 1)[0] for name in known["files"]} | {f"event_month={month}/batch={b}" for b in taken})
    sizes = {n: size for folder in folders for n, size in _data(spark, path, folder)}
    names = [*known["files"], *[n for n in sizes if any(n.startswith(f"event_month={month}/batch={b}/") for b in taken)]]
    if missing := [n for n in names if n not in sizes]:
        raise FileNotFoundError(f"{missing[0]} is in the manifest of month {month} and not there")
    small = [(n, sizes[n]) for n in names if sizes[n] < target // 2]
    groups = [g for g in bins(small, target) if len(g) > 1]
    moved = {n for g in groups for n in g}
    files = [n for n in names if n not in moved]
    if groups:
        inside = f"{PACKED}/event_month={month}/{version + 1:012d}-{uuid.uuid4().hex[:8]}"
        dealt = spark.createDataFrame([(n, k) for k, g in enumerate(groups) for n in g], "name string, bin int")
        place = F.regexp_extract(F.col("_metadata.file_path"), f"((?:{PACKED}/)?event_month=[^/]+/[^/]+/[^/]+)$", 1)
        rows = _files(spark, [f"{path}/{n}" for n in sorted(moved)], schema)
        few = F.broadcast(dealt) if len(moved) <= 100_000 else dealt  # a row per file
        rows = rows.select(F.struct("*").alias("row"), place.alias("name")).join(few, "name")
        spread = rows.repartitionById(len(groups), "bin").sortWithinPartitions("bin", *[f"row.{c}" for c in sort])
        spread.select("row.*").write.parquet(f"{path}/{inside}")
        files += [n for n, _ in _data(spark, path, inside)]
    _commit(spark, path, month, version + 1, {"up_to": max(taken), "files": files, "expired": False})
    return len(names) - len(files)


def expire(spark: SparkSession, path: str, before: str) -> list[str]:
    """Take the months before ``before`` (yyyyMM) out of the history; rows without a time stay."""
    gone = []
    for month in months(spark, path):
        version, known = _manifest(spark, path, month)
        if month.isdigit() and month < before and not known["expired"]:
            _commit(spark, path, month, version + 1, {"up_to": known["up_to"], "files": [], "expired": True})
            gone.append(month)
    return gone


def sweep(spark: SparkSession, path: str) -> int:
    """Remove the files that no manifest names; returns how many. Only for when readers of former manifests are done."""
    removed = 0
    for month in months(spark, path):
        version, known = _manifest(spark, path, month)
        if not version:
            continue
        kept = set(known["files"])
        root = f"event_month={month}"
        old = [b for b in _batches(spark, path, month, -1) if known["expired"] or b <= known["up_to"]]
        folders = [f"{root}/batch={b}" for b in old] + [f"{PACKED}/{root}/{n}" for n, _ in _list(spark, f"{path}/{PACKED}/{root}")]
        for folder in folders:
            names = [n for n, _ in _data(spark, path, folder)]
            gone = names if kept.isdisjoint(names) else [n for n in names if n not in kept]
            for target in [folder] if gone == names else gone:
                fs, file = _folder(spark, f"{path}/{target}")
                fs.delete(file, True)
            removed += len(gone)
    return removed


def maintain(
    spark: SparkSession, path: str, up_to: int, schema: StructType | None, sort: Sequence[str], before: str | None = None, target: int = TARGET
) -> int:
    """Expire, then pack month by month; returns how many fewer files are read."""
    if before:
        expire(spark, path, before)
    return sum(pack(spark, path, month, up_to, schema, sort, target) for month in months(spark, path))
