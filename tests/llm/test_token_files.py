from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cargolens.llm import token_files
from cargolens.llm.common import filesystem
from tests.llm.cases import documents, no_documents, odd_documents, odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "B", " ", "  ", "\n", "\t", "'s", "'LL", "é", "é", " ", "　", "<|endoftext|>", "日本", "1", "23", "!!", "İ", "🙂", "\x00", "\x1c", "ͅ", "̸", "Σ", "\x85", "Å", "가"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_encode_like_the_library(library):
    coder, rng = token_files.coder(PATH), random.Random(2)
    for _ in range(6000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(coder.encode(text), "<u2").tolist() == ids_of(library, text)[:-1], repr(text)


def test_query(spark, library):
    start = 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.query(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(documents())
    for row in sorted(documents(), key=lambda r: r["doc_id"]):
        ids = ids_of(library, row["text"])
        assert got[row["doc_id"]] == (start, len(ids), crc(ids))
        start += len(ids)


def test_odd_rows_index_and_damage(spark, library, tmp_path):
    folder = str(tmp_path / "t")
    manifest = token_files.write(odd_documents(spark), folder, PATH, 1)
    rows = token_files.offsets(token_files.read(manifest), manifest).orderBy("start").collect()
    want = sorted(((r[0], ids_of(library, r[1])) for r in odd_rows()), key=lambda r: (r[0] is not None, r[0]))
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows] == [(k, len(i), crc(i)) for k, i in want]
    entry = manifest.orderBy("file").first()
    files, index = filesystem(entry["index"])
    with files.open_input_file(index) as stream:
        places = np.frombuffer(stream.read(), "<u8")
    assert len(places) == entry["records"]
    assert token_files.read_at(entry["data"], int(places[-1]))[1][-1] == 1
    with open(entry["data"], "r+b") as stream:
        stream.seek(30)
        stream.write(b"\xff\xff")
    with pytest.raises(ValueError, match="checksum"):
        list(token_files.records(open(entry["data"], "rb")))  # noqa: SIM115
    empty = token_files.write(no_documents(spark), str(tmp_path / "e"), PATH, 1)
    assert token_files.offsets(token_files.read(empty), empty).count() == 0


def test_files_are_closed_at_their_size(spark, library, tmp_path):
    manifest = token_files.write(odd_documents(spark), str(tmp_path / "t"), PATH, 1, file_bytes=1000)
    assert manifest.count() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["bytes"] for r in manifest.collect() if r["records"] > 1) < 1000 + 6100 * 2
    rows = token_files.offsets(token_files.read(manifest), manifest).orderBy("start").collect()
    want = sorted(((r[0], ids_of(library, r[1])) for r in odd_rows()), key=lambda r: (r[0] is not None, r[0]))
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows] == [(k, len(i), crc(i)) for k, i in want]


def test_slices_of_a_batch(monkeypatch, library):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 50)
    texts = [None, "", "ab " * 10, "x " * 100, "c", None, "d e " * 40]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["key", "text"])
    cut = list(token_files.slices(batch, 1))
    assert len(cut) > 2 and pa.Table.from_batches(cut).column("text").to_pylist() == texts
    coded = [bytes(ids) for part in cut for ids in token_files.coder(PATH).encode_all(part.column(1))]
    assert [[*np.frombuffer(c, "<u2").tolist(), 1] for c in coded] == [ids_of(library, t) for t in texts]
