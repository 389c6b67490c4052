"""Token ids in length-delimited binary records, with a separate offset index.

A file holds records in ascending key order. Each is framed as in a TFRecord, but with CRC-32: the
length as an unsigned 64-bit integer, a masked checksum of those eight bytes, the payload, and a masked
checksum of the payload, all little-endian. The payload is the key (signed 64 bits), a byte for the width of an
id (2 or 4), and the ids. Beside every file lies an index of one offset per record, so a shuffled
reader seeks to any record without scanning.

Text is dealt by ranges of the key, encoded and written where it arrives; a file that reaches ``FILE_BYTES`` is closed and
the next one begins. Files appear under temporary names and are renamed when complete, so a repeated task leaves the same
files, and a manifest that Spark commits names those that count. No task holds more than a batch.

Defined results: null text counts as empty and keeps its end id; null keys come first and read
back as null; repeated keys keep all their rows; an empty table gives no file and an empty
result; extra columns of the input are not read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.llm.bpe import FIRST_UNASSIGNED, byte_names
from cargolens.llm.common import filesystem, ready
from cargolens.session import shared_dir

#: Entries of each cache of a worker; a full one is set aside, and dropped when the next is full.
CACHE = 400_000
#: Longer words are not kept.
KEEP_CHARS = 64
#: Text that is cut to words at once (a longer text is taken alone), and the size at which a file is closed.
SLICE_BYTES, FILE_BYTES = 8 << 20, 256 << 20
#: A task's files are numbered from its partition times this.
FILES_OF_TASK = 1 << 24
#: Stands for a null key in a file.
NO_KEY = -(1 << 63)
#: Fixed value: the mask constant of the record format.
MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    """CRC-32 of ``data``, rotated and shifted so that checksums of checksums stay harmless."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


class Recent(dict):
    """Values by key, made when first asked for; two generations of ``CACHE`` entries at most are kept."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= KEEP_CHARS:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordCoder:
    """Ids of texts whose tokenizer drops white space: the distinct words of many texts are encoded once, and kept.

    Cutting at ASCII blanks changes nothing there: such a pattern never spans white space, special
    tokens hold none, and no normalisation joins a blank with its neighbours. A word not kept is normalised and cut to pieces as
    the file says, and the library's model encodes each piece not kept; unusual words go through the whole library.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        cut, level = spec["pre_tokenizer"]["pretokenizers"]
        if (cut["type"], cut["behavior"], cut["invert"], level["type"], level["use_regex"], level["add_prefix_space"]) != ("Split", "Removed", True, "ByteLevel", False, False):
            raise ValueError(f"{path}: not a tokenizer of words")
        self.pattern, self.normalizer, self.model = regex.compile(cut["pattern"]["Regex"]), self.tokenizer.normalizer, self.tokenizer.model
        self.names = dict(enumerate(byte_names()))
        self.special = re.compile("|".join(re.escape(t["content"][:2]) for t in spec["added_tokens"]))
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.words, self.pieces = Recent(self.word), Recent(self.piece)

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def piece(self, text: str) -> bytes:
        shown = text if text.isascii() and text.isalpha() else "".join(map(self.names.__getitem__, text.encode()))
        return self.packed([t.id for t in self.model.tokenize(shown)])

    def word(self, text: str) -> bytes:
        plain = text.isascii()
        if self.special.search(text) or not (plain or max(text, default="") < FIRST_UNASSIGNED):
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        normal = text.lower() if plain else self.normalizer.normalize_str(text)
        if normal.isalpha():
            return self.pieces[normal]
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(normal)))

    def encode_all(self, texts: pa.StringArray) -> Iterator[memoryview]:
        """Little-endian ids of each text (null: none)."""
        cut = pc.ascii_split_whitespace(texts.fill_null(""))
        found = cut.flatten().dictionary_encode()
        ids = pa.array(list(map(self.words.__getitem__, found.dictionary.to_pylist())), pa.large_binary()).take(found.indices)
        _, places, data = ids.buffers()
        ends = np.frombuffer(places, "<i8")[cut.offsets.to_numpy()].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return (view[a:b] for a, b in zip(ends, ends[1:], strict=False))

    def encode(self, text: str) -> bytes:
        """Little-endian ids of one text."""
        return bytes(next(self.encode_all(pa.array([text], pa.string()))))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text stays near ``SLICE_BYTES``."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype("i8").cumsum() // SLICE_BYTES
    starts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(starts, starts[1:], strict=False))


_coders: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


def frame(key: int | None, width: int, ids: bytes) -> bytes:
    payload = struct.pack("<qB", NO_KEY if key is None else key, width) + ids
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def records(stream, verify: bool = True) -> Iterator[tuple[int | None, np.ndarray]]:
    """Key and ids of each record of an open file; a wrong checksum or a cut record is an error."""
    while head := stream.read(12):
        size, check = struct.unpack("<QI", head)
        payload = stream.read(size)
        tail = stream.read(4)
        if len(payload) != size or len(tail) != 4:
            raise ValueError("a record is cut short")
        if verify and (check != masked(head[:8]) or struct.unpack("<I", tail)[0] != masked(payload)):
            raise ValueError("a record's checksum is wrong")
        key, width = struct.unpack_from("<qB", payload)
        yield None if key == NO_KEY else key, np.frombuffer(payload, f"<u{width}", offset=9)


def read_at(uri: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset from the index."""
    files, path = filesystem(uri)
    with files.open_input_file(path) as stream:
        stream.seek(offset)
        return next(records(stream))


class TokenFile:
    """The file a task writes at present, with its index; ``close`` renames both and tells the manifest row."""

    def __init__(self, folder: str, number: int):
        self.files, self.root = filesystem(folder)
        self.folder, self.number, self.name, self.mark = folder, number, f"part-{number:012d}", uuid.uuid4().hex
        self.data, self.index = (self.files.open_output_stream(self.temporary(kind), compression=None) for kind in ("tokens", "index"))
        self.size = self.records = self.ids = 0

    def temporary(self, kind: str) -> str:
        return f"{self.root}/_temporary-{self.name}-{self.mark}.{kind}"

    def add(self, record: bytes, ids: int) -> None:
        self.index.write(struct.pack("<Q", self.size))
        self.data.write(record)
        self.size, self.records, self.ids = self.size + len(record), self.records + 1, self.ids + ids

    def close(self) -> tuple:
        for stream, kind in ((self.data, "tokens"), (self.index, "index")):
            stream.close()
            self.files.move(self.temporary(kind), f"{self.root}/{self.name}.{kind}")
        names = (f"{self.folder}/{self.name}.{kind}" for kind in ("tokens", "index"))
        return self.number, *names, self.records, self.ids, self.size


def write(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes the files and the manifest; returns the manifest (file number, names, records, ids, bytes)."""
    spark = ready(docs.sparkSession)
    schema = pa.schema([("file", pa.int64()), ("data", pa.string()), ("index", pa.string()), ("records", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, current, done = coder(vocabulary), None, []
        end = np.array([end_id], f"<u{words.width}").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column(2)[0].as_py() * FILES_OF_TASK
            for rows in slices(batch, 1):
                for k, ids in zip(rows.column(0).to_pylist(), words.encode_all(rows.column(1)), strict=True):
                    if current and current.size >= file_bytes:
                        done.append(current.close())
                        current = None
                    current = current or TokenFile(folder, first + len(done))
                    coded = b"".join((ids, end))
                    current.add(frame(k, words.width, coded), len(coded) // words.width)
        if current:
            done.append(current.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)

    make_folder(folder)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    light = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    ranged = light.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = ranged.select("key", "text", F.spark_partition_id().cast("long").alias("part"))
    rows.mapInArrow(run, "file long, data string, index string, records long, ids long, bytes long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def make_folder(folder: str) -> None:
    files, root = filesystem(folder)
    files.create_dir(root, recursive=True)


def each_file(manifest: DataFrame, name: str, body: Callable, schema: str) -> DataFrame:
    """One task per file of a manifest, as ``body`` streams it."""
    parts = max(1, manifest.count())
    return manifest.select("file", name).repartitionByRange(parts, "file").mapInArrow(body, schema)


def read(manifest: DataFrame) -> DataFrame:
    """Rows of the files: file, place in the file, key, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    schema = pa.schema([("file", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, path = filesystem(uri)
                rows: list[tuple] = []
                with files.open_input_stream(path, compression=None, buffer_size=1 << 20) as stream:
                    for place, (key, ids) in enumerate(records(stream)):
                        rows.append((number, place, key, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 4096:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return each_file(manifest, "data", run, "file long, place long, doc_id long, n_tokens long, ids_crc32 long")


def offsets(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all records before each, from file totals and sums inside a file."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("_file_start"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file")
    return placed.withColumn("start", (F.col("_file_start") + F.col("_inside")).cast("long")).drop("_file_start", "_inside")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the public 49k vocabulary with end id 1, written and read back."""
    from public_tokenizers import path

    folder = shared_dir(spark, "tokens")
    manifest = write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, path("word_bpe_49k.json"), end_id=1)
    return offsets(read(manifest), manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
