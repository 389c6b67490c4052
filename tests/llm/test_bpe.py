from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cargolens.llm import bpe
from tests.llm.cases import DOCS, documents, no_documents, odd_documents, odd_rows, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", " ", "　", "<|endoftext|>", "日本", "1", "23", "!!", "ß", "́", "🙂", "\x00", "\x1c", "aaaa", "࢏", "<|", "|>", "\x85"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), hexed(",".join(map(str, ids))), hexed(library.decode(ids, skip_special_tokens=False))


def test_random_texts_encode_and_decode_like_the_library(library):
    coder, rng = bpe.encoder(PATH), random.Random(4)
    for _ in range(6000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, repr(text)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)
    ids = [rng.randrange(50257) for _ in range(2000)]
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces_take_linear_time(library):
    assert bpe.encoder(PATH).encode("a" * 200_000) == library.encode("a" * 200_000, add_special_tokens=False).ids


def test_a_full_cache_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE", 5)
    coder = bpe.Encoder(PATH)
    for row in documents()[:20]:
        assert coder.encode(row["text"]) == library.encode(row["text"], add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    got = rows_of(bpe.query(spark, "/root/testdata/sf0.001"), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted((r["doc_id"], *expected(library, r["text"])) for r in documents())


def test_odd_rows_and_columns(spark, library):
    got = rows_of(bpe.digests(odd_documents(spark), PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = [(r[0], *expected(library, r[1])) for r in odd_rows()]
    assert got == sorted(want, key=lambda r: (r[0] is not None, r))
    assert bpe.digests(no_documents(spark), PATH).count() == 0


def test_ids_decode_to_the_text(spark):
    coded = bpe.encode(odd_documents(spark), PATH)
    back = bpe.decode(coded, PATH)
    assert set(DOCS.names) < set(back.columns)
    for row in back.collect():
        assert row["decoded"] == (row["text"] or "")
    assert bpe.encode(no_documents(spark), PATH).count() == 0
