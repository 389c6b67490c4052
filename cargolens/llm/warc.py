"""Deterministic sharded WARC archives, and a reader of them.

Records are sorted by page id; running totals of payload bytes cut the order into shards, so which record
lies in which shard follows from the data alone. A shard is written by one task, record by record, each
its own gzip member without a time stamp; a file is closed when its compressed size reaches the limit and the
next one begins. Headers, record ids and digests are made anew; an id comes from page id, url, digest and the place among rows
that are equal in these, so no two records share one. Files are written under
temporary names and renamed when complete; a manifest, committed by Spark, names the files that count. A
repeated task writes the same bytes under the same names.

Of records with equal payloads of ``REVISIT_BYTES`` or more, the one with the smallest page id is the response and the others
revisit it. Payloads are compared by SHA-256 and length in an aggregation, so no task gathers a group of copies.

The plan has a row per record and says everything but the payloads of responses. These come from a second read, and are matched
by page id and digest, never by row numbers, which change with the splits of a scan. A planned response whose payload the second
read does not bring is an error, and so is a shard with more or fewer records or revisits than planned.

Defined results: null html is an empty payload, null urls leave the target out; null page ids come last among equal
payloads and read back as null; repeated rows are records of their own (of rows with equal ids and payloads, the one with the smallest url is the response);
a very long payload is one record of one file; an empty table gives no file and an empty result; extra columns are not written.
The input is read twice: it must be a table or a checkpointed frame.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.llm.common import filesystem, numbered, ready, running, stage
from cargolens.llm.token_files import each_file, make_folder
from cargolens.session import shared_dir

REVISIT_BYTES = 100
#: Payload bytes of a shard, at least (shards grow beyond that many), and the compressed size at which a file is closed.
SHARD_BYTES, MOST_SHARDS, FILE_BYTES = 32 << 20, 1 << 16, 16 << 20
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION, BREAK = b"WARC/1.1", b"\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Headers of our own, so that a record names its row.
PAGE, REFERS_PAGE, LENGTH = "X-Page-ID", "X-Refers-To-Page-ID", "X-Payload-Length"


def plan(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Per row its shard and, for a revisit, the row it refers to; from ids, urls, sizes and digests alone. Payloads too small to be revisited come along."""
    raw = F.coalesce(F.col(html), F.lit(""))
    size = F.octet_length(raw).cast("long")
    light = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), size.alias("size"), F.unhex(F.sha2(raw, 256)).alias("digest"), F.when(size < REVISIT_BYTES, raw).alias("small"))
    by = ["page_id", "digest", "url"]  # rows that are equal in these are the same record
    ranged = running(numbered(light, by).withColumn("one", F.lit(1)), by, "size", ready_ranges=True)
    placed = stage(running(ranged, by, "one", ready_ranges=True, name="number").drop("one"), "placed")
    total = placed.agg(F.sum("size")).head()[0] or 0
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", F.col("url").isNotNull().alias("known"), "url", "_part", "_tie")
    groups = placed.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.min(order).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    repeated = placed.groupBy(*[F.col(c).alias(f"same_{c}") for c in by]).agg(F.min("number").alias("start"), F.count("*").alias("n")).where("n > 1")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"same_{c}"))
    joined = placed.join(groups, ["digest", "size"], "left").join(repeated, same, "left")
    refers = F.when(F.col("first").isNotNull() & (F.col("first") != order), F.col("first"))
    shard = F.expr(f"before div {max(SHARD_BYTES, -(-total // MOST_SHARDS))}").alias("shard")
    return stage(joined.select("page_id", "url", "size", "digest", "small", shard, refers["page_id"].alias("refers_to"), refers["url"].alias("refers_url"), refers.isNotNull().alias("revisit"), F.coalesce(F.col("number") - F.col("start"), F.lit(0)).alias("place")), "plan")


def shard_by(starts: list[tuple], page_id: Column, digest: Column) -> Column:
    """The shard that may want a payload, null for repeats within a batch; ``starts`` are (known, page_id, digest, shard) in order."""
    places, shards = [s[:3] for s in starts], [s[3] for s in starts]

    def run(pages: pd.Series, digests: pd.Series) -> pd.Series:
        known = pages.notna()
        keys = pd.Series(list(zip(known, pages.where(known, 0).astype("int64"), digests, strict=True)), dtype=object)
        found = [shards[max(bisect.bisect_right(places, k) - 1, 0)] for k in keys]
        return pd.Series(found, dtype="Int64").mask(keys.duplicated())

    # Not deterministic: what a batch holds decides which of equal payloads goes on, so it must run once.
    return F.pandas_udf(run, T.LongType()).asNondeterministic()(page_id, digest)


def record_id(page: int | None, url: str | None, digest: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}/{place}/{"" if url is None else f":{url}"}')}>"


def record(
    page: int | None, url: str | None, place: int, payload: bytes, size: int, digest: str, revisit: bool, refers_to: int | None, refers_url: str | None
) -> bytes:
    """One gzip member; a revisit leaves its payload of ``size`` bytes out. A response is the first of the rows equal to it."""
    body = HTTP if revisit else HTTP + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, url, digest, place)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Refers-To", record_id(refers_to, refers_url, digest, 0)), ("WARC-Profile", REVISIT_PROFILE)]
        headers += [] if refers_to is None else [(REFERS_PAGE, refers_to)]
    headers += [] if page is None else [(PAGE, page)]
    headers += [(LENGTH, size), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(body).hexdigest()}")]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(body))]
    head = BREAK.join([VERSION, *[f"{k}: {v}".encode() for k, v in headers]])
    return gzip.compress(head + BREAK * 2 + body + BREAK * 2, compresslevel=6, mtime=0)


class Roll:
    """The file a task writes at present; ``close`` renames it and tells its manifest row."""

    def __init__(self, folder: str, shard: int, number: int):
        self.files, root = filesystem(folder)
        self.name, self.shard, self.size, self.records = f"shard-{shard:06d}-{number:04d}.warc.gz", shard, 0, 0
        self.temporary, self.final = f"{root}/_temporary-{self.name}-{uuid.uuid4().hex}", f"{root}/{self.name}"
        self.stream, self.hash = self.files.open_output_stream(self.temporary, compression=None), hashlib.sha256()

    def add(self, member: bytes) -> None:
        self.stream.write(member)
        self.hash.update(member)
        self.size, self.records = self.size + len(member), self.records + 1

    def close(self) -> tuple:
        self.stream.close()
        self.files.move(self.temporary, self.final)
        return self.name, self.shard, self.records, self.size, self.hash.hexdigest()


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives and the manifest below ``folder``; returns the manifest."""
    spark = ready(pages.sparkSession)
    schema = pa.schema([("name", pa.string()), ("shard", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, number, done, held, wanted = None, 0, [], None, {s: n for s, *n in counts}
        for batch in batches:
            for shard, kind, page, digest, value, uri, size, revisit, refers, refers_url, place in zip(*batch.columns, strict=True):
                shard, page, digest = shard.as_py(), page.as_py(), digest.as_py()
                if not kind.as_py():  # a payload comes before the records of its page and digest
                    held = page, digest, value
                    continue
                uri, size, revisit, payload = uri.as_py(), size.as_py(), revisit.as_py(), b""
                if not revisit:
                    if size >= REVISIT_BYTES and (held is None or held[:2] != (page, digest)):
                        raise RuntimeError(f"the payload of page {page} changed between two reads")
                    payload = (held[2] if size >= REVISIT_BYTES else value).as_py().encode()
                    if len(payload) != size or hashlib.sha256(payload).digest() != digest:
                        raise RuntimeError(f"the payload of page {page} is not the planned one")
                wanted[shard][0] -= 1
                wanted[shard][1] -= revisit
                if roll and (roll.shard != shard or roll.size >= file_bytes):
                    number = number + 1 if roll.shard == shard else 0
                    done.append(roll.close())
                    roll = None
                if roll is None:
                    roll = Roll(folder, shard, number)
                roll.add(record(page, uri, place.as_py(), payload, size, digest.hex(), revisit, refers.as_py(), refers_url.as_py()))
        if roll:
            done.append(roll.close())
        if any(wanted[d[1]] != [0, 0] for d in done):
            raise RuntimeError("a shard does not have its planned records and revisits")
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)

    make_folder(folder)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    planned = plan(pages, key, url, html)
    wants = (F.col("size") >= REVISIT_BYTES) & ~F.col("revisit")  # one row per page id and digest at most
    first = F.min(F.when(wants, F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "digest"))).alias("s")
    shards = planned.groupBy("shard").agg(first, F.count("*").alias("n"), F.count_if("revisit").alias("revisits")).collect()  # MOST_SHARDS + 1 rows at most
    counts = [(r["shard"], r["n"], r["revisits"]) for r in shards]
    starts = sorted((r["s"]["known"], r["s"]["page_id"] or 0, bytes(r["s"]["digest"]), r["shard"]) for r in shards if r["s"])
    noted = planned.select("shard", F.lit(1).alias("kind"), "page_id", "digest", F.col("small").alias("value"), "url", "size", "revisit", "refers_to", "refers_url", "place")
    rows = noted
    if starts:
        full = pages.select(F.col(key).cast("long").alias("page_id"), F.unhex(F.sha2(F.col(html), 256)).alias("digest"), F.col(html).alias("value")).where(F.octet_length("value") >= REVISIT_BYTES)
        full = full.select(shard_by(starts, F.col("page_id"), F.col("digest")).alias("shard"), "page_id", "digest", "value").where("shard IS NOT NULL")
        none = lambda kind: F.lit(None).cast(kind)
        full = full.select("shard", F.lit(0).alias("kind"), "page_id", "digest", "value", none("string").alias("url"), none("long").alias("size"), none("boolean").alias("revisit"), none("long").alias("refers_to"), none("string").alias("refers_url"), none("long").alias("place"))
        rows = full.union(noted)
    ordered = rows.repartition(parts, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "digest", "kind", F.col("url").asc_nulls_first(), "place")
    ordered.mapInArrow(run, "name string, shard long, records long, bytes long, sha256 string").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest").withColumn("uri", F.concat(F.lit(f"{folder}/"), "name"))


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of every record of an open archive; digests that do not hold are an error."""
    source = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while line := source.readline():
        if line.rstrip() != VERSION:
            raise ValueError("not a record")
        headers = {}
        while (line := source.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        body = source.read(int(headers["Content-Length"]))
        if source.read(4) != BREAK * 2 or headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(body).hexdigest()}":
            raise ValueError("a record is damaged")
        yield headers, body[len(HTTP) :]


def read(manifest: DataFrame) -> DataFrame:
    """Rows of the archives that a manifest names, payload digests verified."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    whole = lambda headers, name: int(headers[name]) if name in headers else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(1).to_pylist():
                files, path = filesystem(uri)
                rows = []
                with files.open_input_file(path) as stream:
                    for headers, payload in records(stream):
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and digest != hashlib.sha256(payload).hexdigest():
                            raise ValueError("a payload is damaged")
                        rows.append((whole(headers, PAGE), int(headers[LENGTH]), digest, kind, whole(headers, REFERS_PAGE)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return each_file(manifest.withColumn("file", F.xxhash64("name")), "uri", run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    return read(write(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_dir(spark, "warc")))


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
d AS (SELECT page_id, octet_length(raw) AS n, sha256(raw) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest, n) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {REVISIT_BYTES} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {REVISIT_BYTES} AND first <> page_id THEN first END AS refers_to
FROM f
"""
